"""Scalar building blocks: keys, symbols, dates and null handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candles.schemas import PRICE_COLUMNS

# Names a feed may give its time column, in order of preference; fixed values.
TIME_COLUMNS = ["timestamp", "time", "date", "Date", "datetime"]


def clean_symbol(symbol: str | Column) -> Column:
    return F.upper(F.trim(symbol))


def row_key(*parts: str | Column) -> Column:
    """`a_b_c`; NULL when a part is NULL, so that two rows never share a shortened key."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(known, F.concat_ws("_", *columns))


def normalize_date(df: DataFrame, column: str = "trade_date") -> DataFrame:
    """Bring epoch milliseconds, timestamps, dates or `yyyy-MM-dd` text to DATE."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.LongType, T.IntegerType)):
        value = F.timestamp_millis(value.cast("bigint")).cast("date")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = value.cast("date")
    elif isinstance(kind, T.StringType):
        value = text_date(value)
    elif not isinstance(kind, T.DateType):
        raise ValueError(f"{column}: cannot read {kind.simpleString()} as a date")
    return df.withColumn(column, value)


def text_date(text: str | Column) -> Column:
    """`yyyy-MM-dd` text to DATE, NULL when it is not one."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def text_time(text: str | Column) -> Column:
    """ISO text to TIMESTAMP, NULL when it is not one."""
    return F.try_to_timestamp(text)


def millis_text(millis: str | Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Epoch milliseconds to formatted text."""
    return F.date_format(F.timestamp_millis(millis), pattern)


def detect_time_column(df: DataFrame) -> str:
    for name in TIME_COLUMNS:
        if name in df.columns:
            return name
    raise ValueError(f"no time column among {df.columns}")


def with_time_column(df: DataFrame, name: str = "time") -> DataFrame:
    """Rename whichever known time column the frame has."""
    return df.withColumnRenamed(detect_time_column(df), name)


def coerce_dates(df: DataFrame, column: str = "trade_date") -> DataFrame:
    """Parse the column and drop the rows where that fails."""
    return normalize_date(df, column).na.drop(subset=[column])


def fill_nulls(df: DataFrame) -> DataFrame:
    """Missing prices and volumes become 0."""
    return df.na.fill({c: 0 for c in PRICE_COLUMNS if c in df.columns})


def event_columns(df: DataFrame, time: str = "trade_date") -> DataFrame:
    """`event_date` text, ISO `event_time`, and calendar year and month."""
    at = F.col(time).cast("timestamp")
    return df.withColumns({
        "event_date": F.date_format(at, "yyyy-MM-dd"),
        "event_time": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssXXX"),
        "year": F.year(at),
        "month": F.month(at),
    })


def lookback(end: str | Column, days: int = 0, years: int = 0) -> Column:
    """First day of a range that ends on `end`."""
    end = F.to_date(F.lit(end)) if isinstance(end, str) else end
    return F.date_sub(F.add_months(end, -12 * years), days)


def with_month(df: DataFrame, column: str = "trade_date") -> DataFrame:
    """Add the `yyyy-MM` partition column of the physical monthly split."""
    return df.withColumn("month", F.date_format(column, "yyyy-MM"))

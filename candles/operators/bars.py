"""Building, resampling, selecting and summarising bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candles.operators.quality import newest_first
from candles.operators.series import TICKS, Series, with_past

# Index codes and report types the feeds know.
INDEX_CODES = ["VNINDEX", "HNX-INDEX", "UPCOM-INDEX"]
# Bars of one symbol at different intervals are different series.
SERIES = ("symbol", "interval")
REPORT_TYPES = ["BalanceSheet", "IncomeStatement", "CashFlow"]


def candles(ticks: DataFrame, width: str, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """Ticks to bars of `width` ("5 minutes", "1 hour"); works on streams too.

    Tasks send one partial bar per symbol and bucket, so a busy symbol costs no more than a
    quiet one.
    """
    at = F.struct(*order)
    return (
        ticks.groupBy("symbol", F.window(order[0], width).alias("_window"))
        .agg(
            F.min_by("price", at).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", at).alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("symbol", F.col("_window.start").alias("bucket"), "open", "high", "low", "close", "volume")
    )


def period_end(interval: str, day: str = "trade_date") -> Column:
    """Label of the period a day belongs to: the Sunday that ends its week, or the month's end."""
    if interval == "1W":
        return F.date_add(F.date_trunc("week", day).cast("date"), 6)
    if interval == "1M":
        return F.last_day(day)
    raise ValueError(f"unsupported interval {interval!r}")


def resample(df: DataFrame, interval: str, day: str = "trade_date") -> DataFrame:
    """Daily bars to weekly or monthly ones; "1D" passes through. Bars of other intervals in `df`
    are left out, since a week's bar would count its days again.

    First and last skip missing prices; a period with any missing value is dropped.
    """
    if interval == "1D":
        return df

    def edge(pick, price: str) -> Column:
        # min_by and max_by skip rows whose ordering value is NULL.
        return pick(price, F.when(F.col(price).isNotNull(), F.col(day)))

    return (
        df.filter(F.col("interval") == "1D").groupBy("symbol", period_end(interval, day).alias("period_end"))
        .agg(
            edge(F.min_by, "open").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            edge(F.max_by, "close").alias("close"),
            F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"),
        )
        .na.drop("any")
    )


def price_summary(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
        F.avg("volume").alias("avg_volume"),
    )


def index_summary(df: DataFrame, day: str = "trade_date") -> DataFrame:
    """Extremes, and the first close minus the last."""
    return df.groupBy(*SERIES).agg(
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
        (F.min_by("close", day) - F.max_by("close", day)).alias("close_change"),
    )


def symbols(df: DataFrame) -> DataFrame:
    return df.select("symbol").distinct()


def latest_date(df: DataFrame, key: tuple[str, ...] = SERIES, day: str = "trade_date") -> DataFrame:
    return df.groupBy(*key).agg(F.max(day).alias("latest_date"))


def newest(df: DataFrame, n: int, key: tuple[str, ...] = SERIES, order: tuple[str, ...] = ("trade_date",)) -> DataFrame:
    """The `n` newest rows per key, numbered in `nth`; tasks drop the rest before the shuffle."""
    w = Window.partitionBy(*key).orderBy(*newest_first(list(order), df, list(key)))
    return df.withColumn("nth", F.row_number().over(w)).filter(F.col("nth") <= n)


def latest_row(df: DataFrame, key: tuple[str, ...] = SERIES, day: str = "trade_date") -> DataFrame:
    return newest(df, 1, key, (day,)).drop("nth")


def report_head(df: DataFrame, n: int, report_type: str | None = None) -> DataFrame:
    """The `n` newest periods of every report frame; unknown report types are rejected."""
    if report_type is not None and report_type not in REPORT_TYPES:
        raise ValueError(f"unknown report type {report_type!r}")
    wanted = [report_type] if report_type else REPORT_TYPES
    known = df.filter(F.col("report_type").isin(wanted))
    head = newest(known, n, ("symbol", "report_type", "period"), ("period_end", "report_id"))
    return head.withColumn("rn", F.col("nth").cast("bigint")).drop("nth")


def in_range(df: DataFrame, start: str, end: str, day: str = "trade_date") -> DataFrame:
    """start <= day < end; a monthly split prunes its folders by the same bounds."""
    chosen = df.filter((F.col(day) >= F.lit(start).cast("date")) & (F.col(day) < F.lit(end).cast("date")))
    if "month" in df.columns:
        chosen = chosen.filter(F.col("month").between(start[:7], end[:7]))
    return chosen


def history(
    df: DataFrame, symbol: str | None, start: str, end: str, interval: str | None = None
) -> DataFrame:
    """Bars of one symbol (or all) in [start, end) at an interval."""
    chosen = in_range(df, start, end)
    if symbol is not None:
        chosen = chosen.filter(F.col("symbol") == symbol)
    if interval is not None:
        chosen = chosen.filter(F.col("interval") == interval)
    return chosen


def intraday_page(
    ticks: DataFrame, day: str, size: int = 500, symbol: str | None = None,
    order: tuple[str, ...] = ("ts", "event_id"),
) -> DataFrame:
    """The first `size` trades of a day, of one symbol or of each."""
    start = F.lit(day).cast("date").cast(ticks.schema[order[0]].dataType)
    end = F.date_add(F.lit(day).cast("date"), 1).cast(ticks.schema[order[0]].dataType)
    chosen = ticks.filter((F.col(order[0]) >= start) & (F.col(order[0]) < end))
    if symbol is not None:
        return chosen.filter(F.col("symbol") == symbol).orderBy(*order).limit(size)
    w = Window.partitionBy("symbol").orderBy(*order)
    return chosen.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") <= size).drop("_nth")


def only_symbols(df: DataFrame, wanted: list[str], column: str = "symbol") -> DataFrame:
    return df.filter(F.col(column).isin(wanted))


def only_indices(df: DataFrame, column: str = "symbol", codes: list[str] = INDEX_CODES) -> DataFrame:
    return df.filter(F.col(column).isin(codes))


def listing_of(listing: DataFrame, exchange: str = "ALL", n: int | None = None) -> DataFrame:
    """Symbols of an exchange ("ALL" for every one), all or the first `n`."""
    chosen = listing if exchange == "ALL" else listing.filter(F.col("exchange") == exchange)
    chosen = chosen.select("symbol", "exchange", "company_name")
    return chosen if n is None else chosen.orderBy("symbol").limit(n)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def replay_order(ticks: DataFrame, series: Series | None = None) -> DataFrame:
    """Number the rows of every symbol, so that step i replays the i-th row of each symbol."""
    past = with_past(ticks, series or TICKS, 1, {"n": lambda cur, prev: F.lit(1)})
    return past.filter(~F.col("_copied")).withColumnRenamed("_total_n", "step").drop("_copied", "_slice")

"""Days that a market should have traded, and series that lack some of them.

The calendar comes from all symbols together: a day is a market day if any symbol has a bar, or if
its weekday usually trades, so that a day on which nothing arrived is missed as well. A calendar has one
row per interval and day (some 11,000 in 30 years), and each of its days has a place; a series lacks
days where the places of two of its neighbouring bars are not neighbours. No symbol is ever paired with
all days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

USUAL = 0.5


def market_days(df: DataFrame, holidays: list[str] = (), usual: float = USUAL, day: str = "trade_date") -> DataFrame:
    """(interval, day, place, traded): days from the first to the last bar of an interval.

    A weekday usually trades if it has bars in at least the share `usual` of its weeks. `holidays`
    (yyyy-MM-dd) do not count unless something was traded. Bars of months, whose weekday changes, have only the days they trade on.
    """
    traded = df.select("interval", day).where(F.col(day).isNotNull()).distinct()
    span = traded.groupBy("interval").agg(F.min(day).alias("_low"), F.max(day).alias("_high"))
    every = span.select("interval", F.explode(F.sequence("_low", "_high")).alias(day))
    known = every.join(traded.withColumn("traded", F.lit(True)), ["interval", day], "left")
    known = known.withColumn("traded", F.coalesce("traded", F.lit(False)))
    share = F.avg(F.col("traded").cast("double")).over(Window.partitionBy("interval", F.weekday(day)))
    off = F.date_format(day, "yyyy-MM-dd").isin(list(holidays)) if holidays else F.lit(False)
    wanted = known.withColumn("_share", share).where(F.col("traded") | ((F.col("_share") >= usual) & ~off))
    place = F.row_number().over(Window.partitionBy("interval").orderBy(day))
    return wanted.select("interval", day, place.alias("place"), "traded")


def absent_days(df: DataFrame, holidays: list[str] = (), usual: float = USUAL, day: str = "trade_date") -> DataFrame:
    """(interval, day): market days without a bar of any symbol."""
    return market_days(df, holidays, usual, day).where(~F.col("traded")).select("interval", day)


def outage_islands(
    df: DataFrame, calendar: DataFrame | None = None, least: int = 1, to_end: bool = False, day: str = "trade_date"
) -> DataFrame:
    """(symbol, interval, first_day, last_day, days): stretches of at least `least` market days on which
    a series has no bar, between its first and its last one; with `to_end` also from its last bar to the
    end of the calendar."""
    calendar = market_days(df, day=day) if calendar is None else calendar
    places = calendar.select("interval", day, "place")
    held = df.select("symbol", "interval", day).distinct().join(places, ["interval", day])
    of = Window.partitionBy("symbol", "interval").orderBy("place")
    after = F.lead("place").over(of)
    if to_end:
        ends = places.groupBy("interval").agg((F.max("place") + 1).alias("_end"))
        held = held.join(ends, "interval")
        after = F.coalesce(after, F.col("_end"))
    gaps = held.select("symbol", "interval", (F.col("place") + 1).alias("_from"), (after - 1).alias("_to"))
    gaps = gaps.withColumn("days", F.col("_to") - F.col("_from") + 1).where(F.col("days") >= max(least, 1))
    first = places.select("interval", F.col("place").alias("_from"), F.col(day).alias("first_day"))
    last = places.select("interval", F.col("place").alias("_to"), F.col(day).alias("last_day"))
    found = gaps.join(first, ["interval", "_from"]).join(last, ["interval", "_to"])
    return found.select("symbol", "interval", "first_day", "last_day", F.col("days").cast("bigint").alias("days"))


def missing_days(df: DataFrame, calendar: DataFrame | None = None, to_end: bool = False, day: str = "trade_date") -> DataFrame:
    """(symbol, interval, day): every market day of the islands."""
    calendar = market_days(df, day=day) if calendar is None else calendar
    places = calendar.select("interval", day, "place")
    islands = outage_islands(df, calendar, to_end=to_end, day=day)
    begin = places.select("interval", F.col(day).alias("first_day"), F.col("place").alias("_from"))
    each = islands.join(begin, ["interval", "first_day"]).select(
        "symbol", "interval", F.explode(F.sequence("_from", (F.col("_from") + F.col("days") - 1).cast("int"))).alias("place"))
    return each.join(places, ["interval", "place"]).select("symbol", "interval", day)

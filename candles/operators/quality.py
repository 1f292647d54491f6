"""Row filters, deduplication and data checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from candles.operators.calendar import market_days
from candles.schemas import BAR_KEY


def drop_bad_bars(df: DataFrame, columns: tuple[str, ...] = ("open", "high", "low", "close")) -> DataFrame:
    """Drop rows with a missing price; a missing volume is kept."""
    return df.na.drop(subset=list(columns))


def session_filter(df: DataFrame, end_hour: int = 15, time: str = "ts") -> DataFrame:
    """Keep what happened before the closing hour."""
    return df.filter(F.hour(time) < end_hour)


def newest_first(order: list[str | Column], df: DataFrame, key: list[str]) -> list[Column]:
    """Descending `order`, then every other column, so that ties do not depend on the plan."""
    chosen = [F.col(c) if isinstance(c, str) else c for c in order]
    named = {c for c in order if isinstance(c, str)} | set(key)
    simple = [f.name for f in df.schema.fields
              if f.name not in named and f.dataType.typeName() not in ("map", "variant")]
    return [c.desc_nulls_last() for c in [*chosen, *[F.col(c) for c in simple]]]


def dedup_latest(df: DataFrame, key: list[str] | None = None, order: list[str | Column] = ("event_time",)) -> DataFrame:
    """Keep the newest row per key. Spark keeps one row per key and task before the shuffle."""
    key = list(key or BAR_KEY)
    newest = Window.partitionBy(*key).orderBy(*newest_first(list(order), df, key))
    return df.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The same frame, and an observation whose `get["n"]` is its row count once it has run.

    Counting rides along with the write; it costs no scan of its own.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def completeness(df: DataFrame, min_rows: int, day: str = "trade_date", calendar: DataFrame | None = None) -> DataFrame:
    """Rows per interval and day and whether they reach `min_rows`; with a calendar
    (`calendar.market_days`) also of its days that have no row."""
    counts = df.groupBy("interval", day).agg(F.count(F.lit(1)).alias("n"))
    if calendar is not None:
        counts = calendar.select("interval", day).join(counts, ["interval", day], "left")
        counts = counts.withColumn("n", F.coalesce("n", F.lit(0)))
    return counts.withColumn("ok", F.col("n") >= min_rows)


def is_complete(df: DataFrame, min_rows: int, day: str = "trade_date", holidays: list[str] = ()) -> bool:
    """The gate before training: there is data, no day falls short, and no market day is absent."""
    verdict = completeness(df, min_rows, day, market_days(df, holidays, day=day)).agg(F.min("ok").alias("ok")).first()
    return bool(verdict["ok"])


def lateness(df: DataFrame, hours: int = 2, event: str = "event_time", arrival: str = "ingest_time") -> DataFrame:
    """Rows that arrived more than `hours` after their event."""
    return df.filter(F.col(arrival) - F.col(event) > F.expr(f"interval {int(hours)} hours"))


#: Relative error of a quantile that a sketch tells.
SKETCH_ERROR = 0.01


def lateness_sketch(df: DataFrame, keys: list[str], seconds: str) -> DataFrame:
    """(keys, bucket, n): how many rows are how late, in buckets that grow by a fixed factor.

    Sketches of parts are merged by putting them together: `sketch_quantile` adds up equal buckets. A
    key has as many buckets as its lateness spans factors, some 900 from a second to a year. Rows that are not late (0 or less) share
    one bucket; NULLs do not count.
    """
    width = math.log((1 + SKETCH_ERROR) / (1 - SKETCH_ERROR))
    late = F.col(seconds).cast("double")
    bucket = F.when(late > 0, F.ceil(F.log(late) / F.lit(width))).cast("int")
    return df.where(late.isNotNull()).groupBy(*keys, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def sketch_quantile(sketch: DataFrame, keys: list[str], share: float) -> DataFrame:
    """(keys, n, value): the row at `share` of all rows of a key in order of lateness, within
    `SKETCH_ERROR` of its true value."""
    growth = (1 + SKETCH_ERROR) / (1 - SKETCH_ERROR)
    merged = sketch.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    of = Window.partitionBy(*keys)
    ranked = merged.withColumn("_all", F.sum("n").over(of)).withColumn(
        "_upto", F.sum("n").over(of.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)))
    reached = ranked.where(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(share))).groupBy(*keys).agg(
        F.first("_all").alias("n"), F.min_by(F.struct("bucket"), "_upto").alias("_at"))
    middle = F.pow(F.lit(growth), F.col("_at.bucket")) * 2 / (growth + 1)
    return reached.select(*keys, "n", F.coalesce(middle, F.lit(0.0)).alias("value"))


def late_alerts(sketch: DataFrame, keys: list[str], limit_seconds: float, share: float = 0.99) -> DataFrame:
    """Keys whose lateness at `share` is above the limit."""
    return sketch_quantile(sketch, keys, share).where(F.col("value") > limit_seconds)


def coverage(df: DataFrame, wanted: DataFrame, key: str = "symbol") -> DataFrame:
    """Row count and status of every wanted key, found or not."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0))
    return wanted.select(key).distinct().join(counts, key, "left").select(
        key, n.alias("n"), F.when(n > 0, "success").otherwise("no_data").alias("status")
    )


def coverage_totals(covered: DataFrame) -> DataFrame:
    return covered.groupBy("status").agg(F.count(F.lit(1)).alias("symbols"), F.sum("n").alias("n"))

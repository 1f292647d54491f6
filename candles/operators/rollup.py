"""Candles that can be put together: 1 minute to 5 minutes to 1 hour to 1 day.

A partial candle keeps the trades that opened and closed it with their places, so any two partial candles of a
bucket make one, in whatever order they come: candles of parts of the ticks, of micro-batches, or of
narrower buckets. Ticks are read once, for the narrowest width; each wider one is made of the one before.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candles.session import scratch

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(width: str) -> int:
    """Length of a width such as "5 minutes"."""
    found = re.fullmatch(r"\s*([0-9]+)\s+(second|minute|hour|day)s?\s*", width)
    if not found or not int(found[1]):
        raise ValueError(f"not a width: {width!r}")
    return int(found[1]) * _SECONDS[found[2]]


def partial_candles(ticks: DataFrame, width: str, order: tuple[str, ...] = ("ts", "event_id")) -> DataFrame:
    """(symbol, bucket, first, last, high, low, volume): one row per symbol and bucket that has ticks."""
    trade = F.struct(*order, "price")
    return ticks.groupBy("symbol", F.window(order[0], width).alias("_window")).agg(
        F.min(trade).alias("first"), F.max(trade).alias("last"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.sum("volume").alias("volume"),
    ).select("symbol", F.col("_window.start").alias("bucket"), "first", "last", "high", "low", "volume")


def merge_candles(partials: DataFrame, width: str) -> DataFrame:
    """Partial candles of the same or of narrower buckets to those of `width`."""
    return partials.groupBy("symbol", F.window("bucket", width).alias("_window")).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
    ).select("symbol", F.col("_window.start").alias("bucket"), "first", "last", "high", "low", "volume")


def finished(partials: DataFrame) -> DataFrame:
    return partials.select(
        "symbol", "bucket", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"), "volume")


def fill_empty(candles: DataFrame, width: str) -> DataFrame:
    """Buckets without a trade between a symbol's first and last get the close before them and no
    volume; `traded` tells them apart."""
    step = F.make_dt_interval(secs=F.lit(seconds(width)))
    after = F.lead("bucket").over(Window.partitionBy("symbol").orderBy("bucket"))
    known = candles.withColumn("_after", after)
    gaps = known.where(F.col("_after") > F.col("bucket") + step).select(
        "symbol", F.explode(F.sequence(F.col("bucket") + step, F.col("_after") - step, step)).alias("bucket"), "close")
    empty = gaps.select(
        "symbol", "bucket", *[F.col("close").alias(c) for c in ("open", "high", "low", "close")],
        F.lit(0).cast(candles.schema["volume"].dataType).alias("volume"), F.lit(False).alias("traded"))
    return candles.withColumn("traded", F.lit(True)).unionByName(empty)


def rollups(
    ticks: DataFrame, widths: tuple[str, ...] = ("1 minute", "5 minutes", "1 hour", "1 day"), order: tuple[str, ...] = ("ts", "event_id"),
) -> dict[str, DataFrame]:
    """Partial candles of every width, each from the one before; the narrowest ones are written to
    scratch, so ticks are read once however many widths there are."""
    lengths = [seconds(w) for w in widths]
    if any(b % a or b <= a for a, b in zip(lengths, lengths[1:])):
        raise ValueError(f"each width must be a multiple of the one before: {widths}")
    spark, path = ticks.sparkSession, scratch(ticks.sparkSession, "candles")
    narrow = partial_candles(ticks, widths[0], order)
    narrow.write.parquet(path)
    made = {widths[0]: spark.read.schema(narrow.schema).parquet(path)}
    for before, width in zip(widths, widths[1:]):
        made[width] = merge_candles(made[before], width)
    return made

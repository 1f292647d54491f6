"""What is new since the last run, and the stored view after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candles.operators.quality import newest_first
from candles.schemas import BAR_KEY

SERIES_KEY = ("symbol", "interval")


def latest_per_key(stored: DataFrame, key: tuple[str, ...] = SERIES_KEY, day: str = "trade_date") -> DataFrame:
    return stored.groupBy(*key).agg(F.max(day).alias("_latest"))


def new_rows(
    df: DataFrame,
    stored: DataFrame,
    policy: str = "anti",
    key: tuple[str, ...] = SERIES_KEY,
    day: str = "trade_date",
) -> DataFrame:
    """Rows the stored view lacks.

    "anti": rows whose full key is not stored, so late bars are picked up. "max_date": rows
    after the newest stored date of their series, all rows if there is none. The joins carry
    no broadcast hint: the smaller side grows with the number of symbols, and adaptive
    execution broadcasts it only if its measured size allows.
    """
    if policy == "anti":
        return df.join(stored.select(*key, day), [*key, day], "left_anti")
    if policy == "max_date":
        joined = df.join(latest_per_key(stored, key, day), list(key), "left")
        fresh = F.col("_latest").isNull() | (F.col(day) > F.col("_latest"))
        return joined.filter(fresh).select(*df.columns)
    raise ValueError(f"unknown policy {policy!r}")


def changed_rows(df: DataFrame, stored: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """Rows of `df` that the stored view lacks or has with other values: late and corrected bars."""
    held = stored.select(*key, F.struct(*values).alias("_stored"))
    joined = df.join(held, key, "left")
    return joined.where(~F.struct(*values).eqNullSafe(F.col("_stored"))).select(*df.columns)


def replace_latest(
    stored: DataFrame, incoming: DataFrame, key: list[str] | None = None, order: list[str] = ()
) -> DataFrame:
    """Keyed upsert: one whole row per key, the newest by `order`; on a tie incoming wins."""
    key = list(key or BAR_KEY)
    both = stored.withColumn("_incoming", F.lit(0)).unionByName(incoming.withColumn("_incoming", F.lit(1)))
    newest = Window.partitionBy(*key).orderBy(*newest_first([*order, "_incoming"], both, key))
    return both.withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth", "_incoming")


def staying_keys(stored: DataFrame, incoming: DataFrame, key: list[str], more: list[str] = ()) -> DataFrame:
    """(key, more, _stored): keys of stored rows that no incoming row has, other columns of such a row, and how many
    stored rows have the key. Null keys are equal."""
    names = [*key, *[c for c in more if c not in key]]
    both = stored.select(*names).withColumn("_stored", F.lit(1)).unionByName(incoming.select(*names).withColumn("_stored", F.lit(0)))
    found = both.groupBy(*key).agg(
        *[F.max(c).alias(c) for c in names[len(key):]], F.sum("_stored").cast("bigint").alias("_stored"), F.min("_stored").alias("_kept"))
    return found.filter("_kept = 1").drop("_kept")


def with_keys(df: DataFrame, keys: DataFrame, key: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of `df` whose key is ("left_anti": is not) among `keys`. Null keys are equal."""
    names = {k: f"_its_{k}" for k in key}
    return df.join(keys.select(*key).withColumnsRenamed(names), [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()], how)


def serve(batch: DataFrame, speed: DataFrame, key: list[str] | None = None) -> DataFrame:
    """The batch view plus the speed rows it does not cover yet; `origin` tells them apart."""
    key = list(key or BAR_KEY)
    uncovered = speed.join(batch.select(*key), key, "left_anti")
    return batch.withColumn("origin", F.lit("batch")).unionByName(
        uncovered.withColumn("origin", F.lit("speed")).select(*batch.columns, "origin")
    )


def covered_until(batch: DataFrame, key: tuple[str, ...] = SERIES_KEY, day: str = "trade_date") -> DataFrame:
    """(key, covered): how far the batch view reaches in each series. One row per series; a batch run
    stores it beside its view."""
    return batch.groupBy(*key).agg(F.max(day).alias("covered"))


def uncovered(speed: DataFrame, covered: DataFrame, key: tuple[str, ...] = SERIES_KEY, day: str = "trade_date") -> DataFrame:
    """Speed rows that lie beyond what the batch view covers, and those of series it does not have."""
    joined = speed.join(covered, list(key), "left")
    return joined.filter(F.col("covered").isNull() | (F.col(day) > F.col("covered"))).select(*speed.columns)


def serve_covered(
    batch: DataFrame, speed: DataFrame, covered: DataFrame, key: tuple[str, ...] = SERIES_KEY, day: str = "trade_date"
) -> DataFrame:
    """The batch view plus the speed rows beyond it, like `serve`. The batch view is neither shuffled nor
    read for it: up to its newest row a series belongs to the batch layer, which brings late bars too."""
    fresh = uncovered(speed, covered, key, day).withColumn("origin", F.lit("speed"))
    return batch.withColumn("origin", F.lit("batch")).unionByName(fresh.select(*batch.columns, "origin"))

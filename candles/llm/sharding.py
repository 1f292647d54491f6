"""Sharding by jump consistent hashing, in DataFrame functions only."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candles.llm.common import stored, utf8

#: Fixed values of the method: the multiplier of its generator and the size of its number range.
MULTIPLIER, RANGE = 2862933555777941757, 1 << 31
#: Jumps tried for every key. Each jump at least moves up one shard, so `shards` of them are always
#: enough; a key makes ln(shards) on average, and the few that need more go on in a second pass.
FEW = 64


def jump(key: Column, shards: int) -> Column:
    """The shard (0 to `shards` - 1) of a long key; a null key counts as 0.

    With one more shard a key either stays or moves to the new one, with chance 1 / (shards + 1).
    The generator is 64-bit arithmetic without sign, done in decimals, which do not overflow.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    wide = F.coalesce(key, F.lit(0)).cast("decimal(20,0)")
    unsigned = F.when(wide < 0, wide + F.lit(Decimal(1 << 64))).otherwise(wide)

    def step(state: Column, _: Column) -> Column:
        grown = (state["key"] * F.lit(Decimal(MULTIPLIER)) + F.lit(Decimal(1)))
        grown = (grown % F.lit(Decimal(1 << 64))).cast("decimal(20,0)")
        high = F.floor(grown / F.lit(Decimal(1 << 33))).cast("double")
        moved = F.struct(
            grown.alias("key"), state["next"].alias("at"),
            ((state["next"] + 1).cast("double") * (F.lit(float(RANGE)) / (high + 1.0))).cast("long").alias("next"))
        return F.when(state["next"] < shards, moved).otherwise(state)

    state = F.struct(unsigned.cast("decimal(20,0)").alias("key"), F.lit(-1).cast("long").alias("at"),
                     F.lit(0).cast("long").alias("next"))
    state = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, FEW))), state, step)
    if shards > FEW:
        more = F.when(state["next"] < shards, F.sequence(F.lit(FEW + 1), F.lit(shards)))
        state = F.aggregate(F.coalesce(more, F.array().cast("array<int>")), state, step)
    return state["at"].cast("int")


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, size, text_crc32, law `key`, shard, slot, grown_shard.

    `size` is the text's bytes in UTF-8 plus 1 (null: 1), `text_crc32` that of its bytes. Slots
    number a shard's rows from 0 in key order (nulls first; equal keys by size and checksum),
    without one task seeing a whole shard: rows are cut into ranges of the key, each range counts
    its rows per shard, and running sums of the counts give each range its first slot. A random
    salt, written with the rows, also cuts ranges inside one key that repeats.
    """
    body = utf8(F.col(text))
    rows = docs.select(
        F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        jump(F.col(key).cast("long"), shards).alias("shard"),
        jump(F.col(key).cast("long"), shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_salt"))
    order = [key, "size", "text_crc32", "_salt"]
    cut = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    cut = stored(cut, "shards")
    counts = cut.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("shard", "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("shard", "_range").orderBy(*order)
    numbered = cut.withColumn("_nth", F.row_number().over(within) - 1)
    return numbered.join(firsts, ["shard", "_range"]).select(
        key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_first") + F.col("_nth")).alias("slot"), "grown_shard")

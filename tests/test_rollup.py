"""Candles that are put together from parts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candles.operators import bars as B
from candles.operators import rollup as R

TICK = "symbol string, ts timestamp, event_id bigint, price bigint, volume bigint"
T0 = dt.datetime(2024, 1, 2, 9)


def ticks(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice("AAB"), T0 + dt.timedelta(seconds=rng.randrange(200_000)), i, rng.randrange(50, 99), 1) for i in range(n)]
    return spark.createDataFrame(rows, TICK)


@pytest.mark.parametrize("width", ["1 minute", "5 minutes", "1 hour", "1 day"])
def test_rolled_up_candles_equal_direct_ones(spark, width):
    df = ticks(spark)
    assert sorted(R.finished(R.rollups(df)[width]).collect()) == sorted(B.candles(df, width).collect())


def test_parts_of_the_ticks_make_the_same_candles(spark):
    df = ticks(spark)
    parts = [R.partial_candles(df.where(F.col("event_id") % 5 == k), "1 minute") for k in (3, 0, 4, 1, 2)]
    assert sorted(R.finished(R.merge_candles(B.union_all(parts), "1 hour")).collect()) == sorted(B.candles(df, "1 hour").collect())


def test_ticks_are_read_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = ticks(spark)
    for partial in R.rollups(df.mapInArrow(counted, df.schema)).values():
        R.finished(partial).collect()
    assert seen.value == 400


def test_empty_buckets_carry_the_close(spark):
    rows = [("A", T0, 1, 10, 5), ("A", T0 + dt.timedelta(minutes=3), 2, 12, 5), ("B", T0, 3, 7, 1)]
    got = R.fill_empty(R.finished(R.partial_candles(spark.createDataFrame(rows, TICK), "1 minute")), "1 minute")
    assert sorted((r.symbol, (r.bucket - T0).seconds // 60, r.open, r.close, r.volume, r.traded) for r in got.collect()) == [
        ("A", 0, 10, 10, 5, True), ("A", 1, 10, 10, 0, False), ("A", 2, 10, 10, 0, False), ("A", 3, 12, 12, 5, True), ("B", 0, 7, 7, 1, True)]


def test_widths_must_nest(spark):
    for widths in (("2 minutes", "5 minutes"), ("1 hour", "1 hour"), ("1 hour", "1 minute")):
        with pytest.raises(ValueError, match="multiple"):
            R.rollups(ticks(spark), widths)
    with pytest.raises(ValueError, match="width"):
        R.seconds("1 fortnight")

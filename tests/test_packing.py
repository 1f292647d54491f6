"""Packing of small files, its recovery, and sketches of lateness."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from candles.operators import quality as Q
from candles.sources import packing


def test_first_fit():
    bins = packing.first_fit({"a": 60, "b": 50, "c": 40, "d": 30, "e": 10, "long": 500}, 100)
    assert bins == [["long"], ["a", "c"], ["b", "d", "e"]]
    assert packing.plan({"x": {"a": 10, "b": 20, "c": 90}, "y": {"a": 5}}, 100) == [("x", ["b", "a"])]


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(8000).select("id", F.concat(F.lit("m"), F.col("id") % 3).alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    df.repartition(10).write.partitionBy("month").parquet(path)
    df.where("month = 'm0'").coalesce(1).write.mode("append").partitionBy("month").parquet(path)
    return path


def rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("id", "month", "x").collect()))


def test_small_files_are_packed_and_large_ones_stay(spark, table):
    before, sizes = rows(spark, table), packing.file_sizes(spark, table)
    target = 120_000
    large = {f"{d}/{n}" for d, files in sizes.items() for n, s in files.items() if s >= 0.75 * target}
    assert len(large) == 1 and packing.file_count(sizes) == 31
    fewer = packing.pack(spark, table, ["id"], target)
    after = packing.file_sizes(spark, table)
    assert rows(spark, table) == before and packing.file_count(after) == 31 - fewer <= 9
    assert large <= {f"{d}/{n}" for d, files in after.items() for n in files}
    assert all(s <= target for d, files in after.items() for n, s in files.items() if n.startswith("packed-"))
    assert packing.pack(spark, table, ["id"], target) == 0


def test_an_interrupted_run_is_ended_by_the_next(spark, table, monkeypatch, tmp_path):
    before, recover, calls = rows(spark, table), packing.recover, []

    def stopped(spark, path):
        calls.append(path)
        if len(calls) == 2:
            raise KeyboardInterrupt
        return recover(spark, path)

    monkeypatch.setattr(packing, "recover", stopped)
    monkeypatch.setattr(packing, "scratch_removed", lambda spark: __import__("contextlib").nullcontext())
    with pytest.raises(KeyboardInterrupt):
        packing.pack(spark, table, ["id"], 120_000)
    journal = [f for f in os.listdir(f"{table}/_compaction") if f.endswith(".json")]
    todo = json.load(open(f"{table}/_compaction/{journal[0]}"))
    source, final = todo["moves"][0]
    os.rename(source.removeprefix("file:"), final.removeprefix("file:"))  # stopped after the first move
    assert recover(spark, table) == 1 and recover(spark, table) == 0
    assert rows(spark, table) == before


def test_sketches_merge_and_keep_their_bound(spark):
    rng = random.Random(3)
    data = [(rng.choice("AB"), rng.expovariate(0.01) if rng.random() < 0.9 else 0.0) for _ in range(4000)] + [("C", 0.0), ("C", None), ("D", None)]
    df = spark.createDataFrame(data, "symbol string, seconds double")
    parts = [Q.lateness_sketch(df.where(F.pmod(F.hash("seconds"), F.lit(3)) == k), ["symbol"], "seconds") for k in range(3)]
    merged = parts[2].unionByName(parts[0]).unionByName(parts[1])
    for share in (0.05, 0.5, 0.99, 1.0):
        found = {r.symbol: (r.n, r.value) for r in Q.sketch_quantile(merged, ["symbol"], share).collect()}
        for symbol in "AB":
            true = sorted(x for s, x in data if s == symbol)
            want = true[max(-(-len(true) * int(share * 100) // 100), 1) - 1]
            assert found[symbol][0] == len(true) and found[symbol][1] == pytest.approx(want, rel=0.0101, abs=1e-12)
        assert found["C"] == (1, 0.0) and "D" not in found
    assert {r.symbol for r in Q.late_alerts(merged, ["symbol"], 100).collect()} == {"A", "B"}

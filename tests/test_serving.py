"""Early stops, coverage, folding and eviction of micro-batches, sealed months, walk-forward fits, slices."""

import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candles.functions import columns as C
from candles.operators import incremental as INC
from candles.operators import series as SE
from candles.operators.bars import replay_order
from candles.plans import jobs, predict
from candles.schemas import BAR_KEY
from candles.sources import readers, sinks

BAR = "symbol string, interval string, trade_date date, open double, high double, low double, close double, volume bigint"
DAY0 = dt.date(2020, 1, 1)


def bar(symbol, day, close=10.0, volume=1):
    return (symbol, "1D", DAY0 + dt.timedelta(days=day), close, close, close, close, volume)


def frame(spark, rows):
    return spark.createDataFrame(rows, BAR)


@pytest.fixture
def monthly(spark, tmp_path):
    df = C.with_month(frame(spark, [bar(s, d, volume=d) for s in "AB" for d in range(0, 900)]))
    sinks.write_bars(df, f"{tmp_path}/bars")
    return readers.read_bars(spark, f"{tmp_path}/bars", df.schema)


@pytest.mark.parametrize("where,n,months", [(None, 10, 1), ("volume < 800", 10, 4), ("volume = 3", 2, 30), ("volume < 0", 5, 30)])
def test_search_reads_only_as_many_months_as_it_must(monthly, monkeypatch, where, n, months):
    seen, search = [], jobs.search
    monkeypatch.setattr(jobs, "search", lambda df, predicate, n: seen.append(df.select("month").distinct().count()) or search(df, predicate, n))
    found = jobs.search_early(monthly, where, n)
    assert found.collect() == search(monthly, where, n).collect()
    assert seen[-1] == months and len(jobs.folder_months(monthly)) == 30


def test_rows_beyond_the_batch_view_are_served(spark):
    batch = frame(spark, [bar("A", d) for d in range(10)] + [bar("B", 3)])
    speed = frame(spark, [bar("A", 9, 99.0), bar("A", 10, 11.0), bar("B", 4, 12.0), bar("NEW", 0, 13.0)])
    covered = INC.covered_until(batch)
    served = INC.serve_covered(batch, speed, covered)
    assert sorted(r.close for r in served.filter("origin = 'speed'").collect()) == [11.0, 12.0, 13.0]
    assert served.count() == 14
    assert sorted(map(tuple, served.collect())) == sorted(map(tuple, INC.serve(batch, speed).collect()))
    plan = served._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_covered_batches_are_evicted(spark, tmp_path):
    path = f"{tmp_path}/speed"
    for n, days in enumerate(((0, 1), (1, 5), (2, 3), (0, 1))):
        sinks.write_batch(frame(spark, [bar("A", d) for d in days]), path, n)
    covered = INC.covered_until(frame(spark, [bar("A", 3)]))
    assert sinks.evict_batches(spark, path, covered) == 2
    assert sinks.batch_numbers(spark, path) == [1, 3]
    assert sinks.evict_batches(spark, path, covered) == 0


def test_batches_are_folded_into_the_table(spark, tmp_path):
    path, table = f"{tmp_path}/speed", f"{tmp_path}/bars"
    sinks.upsert(C.with_month(frame(spark, [bar("A", 0, 1.0), bar("A", 40, 1.0)])), table, BAR_KEY)
    for n, rows in enumerate(([bar("A", 0, 2.0), bar("A", 1, 2.0)], [bar("A", 1, 3.0)], [bar("A", 2, 4.0)])):
        sinks.write_batch(C.with_month(frame(spark, rows)), path, n)
    assert sinks.fold_batches(spark, path, table, BAR_KEY) == 2
    got = sorted((r.trade_date, r.close) for r in spark.read.parquet(table).collect())
    assert [c for _, c in got] == [2.0, 3.0, 1.0] and sinks.batch_numbers(spark, path) == [2]
    assert sinks.fold_batches(spark, path, table, BAR_KEY) == 0


def test_sealed_months_are_read_only(spark, tmp_path):
    table = f"{tmp_path}/bars"
    sinks.upsert(C.with_month(frame(spark, [bar("A", 0), bar("A", 40)])), table, BAR_KEY)
    sinks.seal(spark, table, ["2020-01"])
    with pytest.raises(ValueError, match="sealed.*2020-01"):
        sinks.upsert(C.with_month(frame(spark, [bar("A", 1), bar("A", 41)])), table, BAR_KEY)
    assert spark.read.parquet(table).count() == 2
    sinks.upsert(C.with_month(frame(spark, [bar("A", 41)])), table, BAR_KEY)
    assert spark.read.parquet(table).count() == 3 and sinks.sealed(spark, table) == {"2020-01"}


def test_csv_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = frame(spark, [bar("A", d) for d in range(7)])
    assert sinks.write_csv(df.mapInArrow(counted, df.schema), f"{tmp_path}/full")
    assert seen.value == 7 and len(readers.read_csv(spark, f"{tmp_path}/full", BAR).collect()) == 7
    assert not sinks.write_csv(df.limit(0), f"{tmp_path}/none") and not os.path.exists(f"{tmp_path}/none")
    assert not sinks.write_csv(None, f"{tmp_path}/none")


def test_walk_forward_equals_a_fit_at_every_date(spark):
    rng = random.Random(2)
    rows = [bar(s, d, None if d == 17 else float(rng.randrange(80, 120))) for s in "AB" for d in range(40)] + [bar("C", d, 5.0) for d in range(6)]
    fitted = {(r.symbol, (r.trade_date - DAY0).days): r for r in predict.walk_forward(frame(spark, rows)).collect()}
    closes = {s: [r[6] for r in rows if r[0] == s] for s in "ABC"}
    for (symbol, day), r in fitted.items():
        known = closes[symbol][:day + 1]
        pairs = [(x, y) for x, y in zip(known, known[1:]) if x is not None and y is not None]
        if len(pairs) < 2 or len({x for x, _ in pairs}) < 2:
            assert r.slope is None and r.prediction is None
            continue
        slope, intercept = np.polyfit(*np.array(pairs).T, 1)
        assert (r.slope, r.intercept) == (pytest.approx(slope), pytest.approx(intercept))
        if closes[symbol][day] is not None:
            assert r.prediction == pytest.approx(intercept + slope * closes[symbol][day])
    assert len(fitted) == 86


def test_the_forest_learns_what_can_be_learned(spark):
    bars = frame(spark, [bar("A", d, 100.0 + d) for d in range(80)])
    row = predict.forest_against_mean(bars, "2020-03-01", trees=5).first()
    assert row.beats_mean and row.n == 19


def test_slices_of_a_hot_symbol_stay_small(spark, monkeypatch):
    """One symbol has nine tenths of the ticks; slices have about so many rows as is asked."""
    monkeypatch.setattr(SE, "SLICE_ROWS", 1000)
    for n in (2_000, 60_000):
        ticks = spark.range(n).select(
            F.when(F.col("id") % 10 == 0, "B").otherwise("A").alias("symbol"),
            F.timestamp_seconds("id").alias("ts"), F.col("id").alias("event_id"))
        sizes = [r.n for r in SE.TICKS.cut(ticks).groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == n and max(sizes) < 2_500
    last = replay_order(ticks).groupBy("symbol").agg(F.max("step").alias("n"))
    assert {r.symbol: r.n for r in last.collect()} == {"A": 54_000, "B": 6_000}

"""What is read several times is made once, and copied no oftener than needed."""

import json
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from candles.plans import jobs, predict
from candles.sources import sinks

BARS = "symbol string, interval string, trade_date date, open double, high double, low double, close double, volume long"


def bars_of(spark, symbols, days, price=lambda s, d: 100.0 + d):
    rows = [(s, "1D", date(2020, 1, 1) + timedelta(d), *[price(s, d)] * 4, 10 + d) for s in symbols for d in range(days)]
    return spark.createDataFrame(rows, BARS)


def test_the_forest_counts_the_test_rows_of_every_symbol(spark):
    bars = bars_of(spark, ["A", "B"], 80).unionByName(bars_of(spark, ["C"], 50)).unionByName(bars_of(spark, [None], 62))
    made = predict.forest_by_symbol(bars, "2020-03-01", trees=5).collect()
    assert {(r.model, r.symbol, r.n, r.beats_mean) for r in made} == {
        ("forest", "A", 19, True), ("forest", "B", 19, True), ("forest", None, 1, True)}


def test_both_sides_of_a_split_read_one_written_copy(spark):
    train, test = predict.split_once(bars_of(spark, ["A", "B"], 80), "2020-03-01", "symbol")
    assert (train.count(), test.count()) == (120, 38)
    assert {f.rsplit("/", 1)[0] for f in train.inputFiles()} == {f.rsplit("/", 1)[0] for f in test.inputFiles()} != set()


def test_partitions_to_fit_on_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(predict, "FIT_ROWS", 500)
    for n in (1_000, 20_000):
        sizes = predict.spread(spark.range(n).coalesce(1)).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == n and max(r["count"] for r in sizes) <= 600
    few = spark.range(400).coalesce(1)
    assert predict.spread(few) is few


def event(symbol, day, **more):
    return json.dumps({"symbol": symbol, "interval": "1D", "event_date": day, "event_time": f"{day}T00:00:00Z", "source": "t",
                       "data": {"open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 7}, **more})


def test_the_copy_of_a_feed_has_the_text_of_few_events(spark, monkeypatch, tmp_path):
    texts = [event("A", "2020-01-01"), event("B", "2020-01-02"), event("C", "soon"), "{no json", event("D", "2020-01-03", interval="1m"),
             event("D", "2020-01-03", interval="1m", bar_time="2020-01-03T09:15:00Z")]
    copies = []
    write = jobs._computed
    monkeypatch.setattr(jobs, "_computed", lambda df, name: copies.append(write(df, name)) or copies[-1])
    seen = []
    land = sinks.upsert
    monkeypatch.setattr(jobs, "upsert", lambda *a, **k: seen.append({r.value for r in copies[-1].collect()}) or land(*a, **k))
    for _ in range(2):
        assert jobs.land_ohlcv(spark.createDataFrame([(t,) for t in texts], "value string"), f"{tmp_path}/bars") == 2
    assert all(s == {None, texts[2], texts[3], texts[4]} for s in seen) and len(seen) == 4
    assert spark.read.parquet(f"{tmp_path}/bars").count() == 4
    assert {r.value for r in spark.read.parquet(f"{tmp_path}/bars.rejected").collect()} == {texts[2], texts[3]}


def test_an_upsert_copies_incoming_rows_at_most_once(spark, monkeypatch, tmp_path):
    path, copies = f"{tmp_path}/table", []
    make = sinks.scratch
    monkeypatch.setattr(sinks, "scratch", lambda spark, name: copies.append(name) or make(spark, name))
    schema = "symbol string, interval string, month string, version int, close long"
    put = lambda rows, **k: sinks.upsert(spark.createDataFrame(rows, schema), path, ["symbol", "interval", "month"], ["version"], **k)
    put([("A", "1D", "2020-01", 1, 1), ("A", "1D", "2020-01", 2, 2), (None, "1D", "2020-01", 1, 3), ("B", "1D", "2020-02", 1, 4)])
    put([("A", "1D", "2020-01", 2, 1), ("A", "1D", "2020-01", 1, 9), (None, "1D", "2020-01", 1, 5), (None, "1D", "2020-01", 0, 6)], stored_rows=True)
    assert copies == ["arrived"]
    assert {(r.symbol, r.month, r.version, r.close) for r in spark.read.parquet(path).collect()} == {
        ("A", "2020-01", 2, 1), (None, "2020-01", 1, 5), ("B", "2020-02", 1, 4)}


TABLE = "symbol string, interval string, trade_date date, month string, close long, extra long"


def put(spark, path, rows, **more):
    made = [(s, "1D", d and date(2020, m, d), f"2020-0{m}", close, None) for s, m, d, close in rows]
    sinks.upsert(spark.createDataFrame(made, TABLE), path, ["symbol", "interval", "trade_date"], **more)


@pytest.mark.parametrize("sent", [0, 100_000])
@pytest.mark.parametrize("incoming", [
    [("A", 1, 1, 10), ("A", 1, 2, 11), (None, 1, 1, 12), ("B", 2, 1, 13), ("B", 2, None, 14)],
    [("A", 1, 2, 10), (None, 1, 1, 11)],
    [("B", 2, None, 10), ("C", 2, 1, 11), ("C", 3, 1, 12), ("C", 2, 4, 13), ("C", 2, 5, 14)],
])
def test_an_upsert_keeps_what_does_not_come_in(spark, monkeypatch, tmp_path, incoming, sent):
    """Null keys are equal; of stored rows with one key one stays, whether keys are sent or dealt out."""
    monkeypatch.setattr(sinks, "SENT_KEYS", sent)
    stored = [("A", 1, 1, 1), ("A", 1, 2, 2), (None, 1, 1, 3), ("B", 2, 1, 4), ("B", 2, None, 5), ("B", 3, 1, 6)]
    for repeats in ([], [("B", 2, 1, 7), ("B", 3, 1, 8), ("A", 1, 1, 9)]):
        path = f"{tmp_path}/{len(repeats)}"
        sinks.write_bars(spark.createDataFrame(
            [(s, "1D", d and date(2020, m, d), f"2020-0{m}", close, None) for s, m, d, close in stored + repeats], TABLE), path)
        put(spark, path, incoming)
        want = {}
        for rows in (sorted(stored + repeats, key=lambda r: r[3]), incoming):
            want |= {(s, m, d): close for s, m, d, close in rows}
        # Folders that the incoming rows do not touch stay as they are.
        months = {m for _, m, _, _ in incoming}
        want = sorted([(str(s), m, str(d), c) for (s, m, d), c in want.items() if m in months]
                      + [(str(s), m, str(d), c) for s, m, d, c in stored + repeats if m not in months])
        got = sorted((str(r.symbol), int(r.month[-1]), str(r.trade_date and r.trade_date.day), r.close) for r in spark.read.parquet(path).collect())
        assert got == want


def test_replaced_rows_are_not_shuffled(spark, monkeypatch, tmp_path):
    put(spark, f"{tmp_path}/bars", [("A", 1, d, d) for d in range(1, 29)])
    plans, write = [], sinks.write_bars
    monkeypatch.setattr(sinks, "write_bars", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, *a, **k))
    put(spark, f"{tmp_path}/bars", [("A", 1, d, -d) for d in range(1, 28)])
    assert "Exchange hashpartitioning" not in plans[0] and "Window" not in plans[0]
    assert sorted(r.close for r in spark.read.parquet(f"{tmp_path}/bars").collect()) == [*range(-27, 0), 28]


def test_shuffle_files_go_with_their_action(spark):
    def files():
        found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())} if found.size() else set()

    before = {f for f in files() if f.startswith("shuffle_")}
    assert spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    for _ in range(50):
        if not {f for f in files() if f.startswith("shuffle_")} - before:
            break
        time.sleep(0.1)
    assert not {f for f in files() if f.startswith("shuffle_")} - before

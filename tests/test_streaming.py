"""Streams: replays, restarts, late rows, memory across micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candles.operators import bars as B
from candles.operators import indicators as I
from candles.operators.series import TICKS
from candles.sources import sinks
from candles.streaming import bars as S

T0 = dt.datetime(2024, 1, 2, 9)
TICK = "symbol string, ts timestamp, event_id bigint, price bigint, volume bigint"


def tick(i, symbol="A", price=None, minutes=None):
    return (symbol, T0 + dt.timedelta(minutes=i if minutes is None else minutes), i, 100 + i if price is None else price, 1)


class Feed:
    """A folder of Parquet files that a stream reads as they arrive."""

    def __init__(self, spark, tmp_path):
        self.spark, self.root = spark, str(tmp_path)

    def add(self, *rows):
        self.spark.createDataFrame(list(rows), TICK).write.mode("append").parquet(f"{self.root}/in")

    def stream(self):
        schema = self.spark.createDataFrame([], TICK).schema
        return self.spark.readStream.schema(schema).parquet(f"{self.root}/in")

    def drain(self, df, each, mode="append"):
        S.start(df, each, f"{self.root}/checkpoint", {"availableNow": True}, mode).awaitTermination()


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_memory_continues_where_the_batch_before_ended(feed, spark):
    rows = [tick(i, s, price=100 + (i * 7) % 13) for i in range(60) for s in ("A", "B")]
    memory = {"sma": S.Remembered(f"{feed.root}/sma"), "ema": S.Remembered(f"{feed.root}/ema")}

    def each(df, batch_id):
        memory["sma"].sma(20)(df, batch_id)
        memory["ema"].ema(5)(df, batch_id)

    for part in (rows[:10], rows[10:70], rows[70:71], rows[71:]):
        feed.add(*part)
        feed.drain(feed.stream(), each)
    whole = spark.createDataFrame(rows, TICK).withColumn("close", F.col("price").cast("double"))
    for name, batch in (("sma", I.sma(whole, 20, TICKS, "value")), ("ema", I.ema(whole, {"value": 5}, series=TICKS))):
        mine = {(r.symbol, r.event_id): r.value for r in memory[name].result(spark).collect()}
        expected = {(r.symbol, r.event_id): r.value for r in batch.collect()}
        assert mine == {k: pytest.approx(v) if v is not None else None for k, v in expected.items()}
    assert memory["sma"].late(spark).count() == 0


def test_a_replayed_batch_changes_nothing(feed, spark):
    memory = S.Remembered(f"{feed.root}/memory")
    each = memory.ema(5)
    first = spark.createDataFrame([tick(i) for i in range(10)], TICK)
    second = spark.createDataFrame([tick(i) for i in range(10, 20)], TICK)
    for batch_id, rows in ((0, first), (1, second)):
        each(rows, batch_id)
    once = sorted(memory.result(spark).collect())
    for batch_id, rows in ((1, second), (0, first), (1, second)):
        each(rows, batch_id)
    assert sorted(memory.result(spark).collect()) == once and len(once) == 20


def test_lost_state_is_noticed(feed, spark):
    each = S.Remembered(f"{feed.root}/memory").sma(3)
    with pytest.raises(ValueError, match="state"):
        each(spark.createDataFrame([tick(1)], TICK), 7)


def test_scratch_and_old_state_are_removed(feed, spark):
    import os

    from candles.session import scratch_root

    before = set(os.listdir(scratch_root(spark)))
    each = S.Remembered(f"{feed.root}/memory").rsi(14)
    for i in range(4):
        each(spark.createDataFrame([tick(i)], TICK), i)
    assert set(os.listdir(scratch_root(spark))) == before
    assert sorted(os.listdir(f"{feed.root}/memory/state")) == ["2", "3"]


def test_late_rows_are_kept_apart(feed, spark):
    memory = S.Remembered(f"{feed.root}/memory")
    each = memory.sma(3)
    each(spark.createDataFrame([tick(i) for i in range(5)], TICK), 0)
    each(spark.createDataFrame([tick(2), tick(5), tick(0, "NEW")], TICK), 1)
    assert [r.event_id for r in memory.late(spark).collect()] == [2]
    last = memory.result(spark).filter("event_id = 5").first()
    assert last.value == 104.0 and memory.result(spark).filter("symbol = 'NEW'").count() == 1


def test_candles_drop_ticks_behind_the_watermark(feed, spark):
    sink = S.append_batches(f"{feed.root}/out")

    def drain():
        feed.drain(S.stream_candles(feed.stream(), "5 minutes", "10 minutes"), sink)

    feed.add(tick(0), tick(1), tick(40))
    drain()
    feed.add(tick(2), tick(90))  # tick 2 is later than the watermark allows
    drain()
    feed.add(tick(200))
    drain()
    out = {r.bucket: (r.open, r.close, r.volume) for r in spark.read.parquet(f"{feed.root}/out").collect()}
    assert out[T0] == (100, 101, 2)
    assert out[T0 + dt.timedelta(minutes=40)] == (140, 140, 1)


def test_stream_candles_equal_batch_candles_when_nothing_is_late(feed, spark):
    rows = [tick(i, s, minutes=i / 3) for i in range(90) for s in ("A", "B")]
    sink = S.append_batches(f"{feed.root}/out")
    for part in (rows[:50], rows[50:100], rows[100:]):
        feed.add(*part)
        feed.drain(S.stream_candles(feed.stream(), "5 minutes", "10 minutes"), sink, "update")
    mine = sinks.read_batches(spark, f"{feed.root}/out", ["symbol", "bucket"])
    batch = B.candles(spark.createDataFrame(rows, TICK), "5 minutes")
    assert sorted(mine.select(*batch.columns).collect()) == sorted(batch.collect())


def test_repeats_are_dropped_over_batches(feed, spark):
    sink = S.append_batches(f"{feed.root}/out")
    for part in ([tick(0), tick(0), tick(1)], [tick(1), tick(2)], [tick(2), tick(2)]):
        feed.add(*part)
        feed.drain(S.dedup_stream(feed.stream(), ["symbol", "event_id", "ts"], "ts"), sink)
    assert sorted(r.event_id for r in spark.read.parquet(f"{feed.root}/out").collect()) == [0, 1, 2]


def test_one_step_ema_restarts_with_each_batch(feed, spark):
    each = S.ema_batches(f"{feed.root}/out", 5, TICKS, value="price")
    for part in ([tick(0), tick(1)], [tick(2), tick(3)]):
        feed.add(*part)
        feed.drain(feed.stream(), each)
    each(spark.createDataFrame([], TICK), 99)  # an empty batch adds nothing
    out = sinks.read_batches(spark, f"{feed.root}/out", ["es_id"]).orderBy("ts").collect()
    assert [r.ema for r in out] == [None, pytest.approx(101 / 3 + 100 * 2 / 3), None, pytest.approx(103 / 3 + 102 * 2 / 3)]
    assert out[0].es_id == "A_2024-01-02 09:00:00"

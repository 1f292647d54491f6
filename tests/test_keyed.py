"""Stream indicators in the state store: restarts, late rows, rows without a value, forgotten series."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candles.operators import indicators as I
from candles.operators.series import TICKS
from candles.streaming import bars as S
from candles.streaming import keyed

T0 = dt.datetime(2024, 1, 2, 9)
TICK = "symbol string, ts timestamp, event_id bigint, price bigint"
WANTED = {"ma20": ("sma", 20), "ma3": ("sma", 3), "rsi5": ("rsi", 5), "ema5": ("ema", 5)}


def tick(i, symbol="A", price=0):
    return (symbol, T0 + dt.timedelta(minutes=i), i, price)


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of rows, and a function that reads what is new there with a stream of its own."""
    root = str(tmp_path)
    keyed.keep_state(spark)

    def add(rows, **options):
        spark.createDataFrame(rows, TICK).write.mode("append").parquet(f"{root}/in")
        rows = spark.readStream.schema(TICK).parquet(f"{root}/in")
        stream = keyed.keyed_indicators(rows, options.pop("wanted", WANTED), **options)
        S.start(stream, S.append_batches(f"{root}/out"), f"{root}/checkpoint", {"availableNow": True}).awaitTermination()
        return spark.read.parquet(f"{root}/out")

    return add


def test_restarts_go_on_where_the_stream_stopped(feed, spark):
    rng = random.Random(1)
    rows = [tick(i, s, rng.randrange(90, 110)) for i in range(60) for s in ("A", "B", None)]
    for part in (rows[:10], rows[10:100], rows[100:101], rows[101:]):
        part = list(part)
        rng.shuffle(part)
        out = feed(part)
    assert out.filter("late").count() == 0
    mine = {(r.symbol, r.event_id): (r.ma20, r.ma3, r.rsi5, r.ema5) for r in out.collect()}
    whole = spark.createDataFrame(rows, TICK).withColumn("close", F.col("price").cast("double"))
    whole = I.ema(I.rsi(I.sma(I.sma(whole, 20, TICKS), 3, TICKS), 5, TICKS), {"ema5": 5}, series=TICKS)
    want = {(r.symbol, r.event_id): (r.ma20, r.ma3, r.rsi5, r.ema5) for r in whole.collect()}
    assert mine.keys() == want.keys() and len(mine) == 180
    for key, values in want.items():
        assert mine[key] == tuple(pytest.approx(v) if v is not None else None for v in values)


def test_late_and_repeated_rows_change_nothing(feed):
    feed([tick(i, price=i) for i in range(5)])
    out = feed([tick(2, price=99), tick(4, price=99), tick(5, price=5), tick(0, "NEW", 7)])
    late = {r.event_id: (r.ma3, r.ema5) for r in out.filter("late").collect()}
    assert late == {2: (None, None), 4: (None, None)}
    assert out.filter("event_id = 5").first().ma3 == 4.0
    assert out.filter("symbol = 'NEW'").first().ema5 == 7.0


def test_rows_without_a_value(feed):
    feed([tick(0, price=None), tick(1, price=1), tick(2, price=2), tick(3, price=None)])
    out = {r.event_id: (r.ma3, r.ema5) for r in feed([tick(4, price=3), tick(5, price=None)]).collect()}
    assert [out[i][0] for i in range(6)] == [None, None, None, None, 2.0, None]
    assert out[0][1] is None and out[1][1] == 1.0


def test_idle_series_are_forgotten(feed):
    """A lies idle for two days while B goes on; then A starts afresh."""
    options = {"idle": "1 day", "delay": "1 minute", "wanted": {"ema5": ("ema", 5)}}
    feed([tick(0, price=100), tick(0, "B", 1)], **options)
    feed([tick(1, price=130), tick(1, "B", 1)], **options)
    feed([tick(3000, "B", 1)], **options)
    feed([tick(3001, "B", 1)], **options)
    out = feed([tick(3002, price=50), tick(3002, "B", 4)], **options)
    mine = {(r.symbol, r.event_id): r.ema5 for r in out.collect()}
    assert mine["A", 1] == pytest.approx(110) and mine["A", 3002] == 50 and mine["B", 3002] == pytest.approx(2)


def test_unknown_indicators_are_refused(spark):
    rows = spark.createDataFrame([tick(1)], TICK)
    with pytest.raises(ValueError, match="unknown"):
        keyed.keyed_indicators(rows, {"x": ("median", 3)})
    with pytest.raises(ValueError, match="no indicators"):
        keyed.keyed_indicators(rows, {})
    with pytest.raises(ValueError, match="both"):
        keyed.keyed_indicators(rows, WANTED, idle="1 day", ttl_ms=5)

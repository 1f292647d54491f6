"""Slices must not change any result, whatever their length and however rows are spread."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candles.operators import indicators as I
from candles.operators.bars import replay_order
from candles.operators.series import BARS, TICKS, Series, with_past

START = dt.date(2019, 12, 25)


def random_bars(spark, seed=0, hot=400, cold=12):
    """One symbol with most of the rows, in bursts and gaps, and a few short ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for symbol, n in {"HOT": hot, **{f"C{i}": cold + i for i in range(5)}}.items():
        gaps = rng.choice([1, 1, 1, 2, 40, 400], size=n)
        for day in np.cumsum(gaps):
            rows.append((symbol, "1D", START + dt.timedelta(days=int(day)), int(rng.integers(90, 110)), int(rng.integers(0, 50))))
    return spark.createDataFrame(rows, "symbol string, interval string, trade_date date, close bigint, volume bigint")


def brute(pdf):
    """The definitions, one symbol at a time, on plain lists."""
    out = []
    for _, g in pdf.sort_values("trade_date").groupby("symbol"):
        c, v = g.close.tolist(), g.volume.tolist()
        rets = [0.0] + [(b - a) / a * 100 for a, b in zip(c, c[1:])]
        chg = [0] + [b - a for a, b in zip(c, c[1:])]
        for i in range(len(c)):
            n = i + 1
            gain = sum(max(x, 0) for x in chg[max(0, i - 13):n]) / 14
            loss = sum(max(-x, 0) for x in chg[max(0, i - 13):n]) / 14
            out.append({
                "symbol": g.symbol.iloc[0], "trade_date": g.trade_date.iloc[i],
                "vwap": sum(a * b for a, b in zip(c[:n], v[:n])) / max(sum(v[:n]), 1),
                "ma7": sum(c[i - 6:n]) / 7 if n >= 7 else np.nan,
                "ma30": sum(c[i - 29:n]) / 30 if n >= 30 else np.nan,
                "bollinger_upper": np.mean(c[i - 29:n]) + 2 * np.std(c[i - 29:n]) if n >= 30 else np.nan,
                "daily_return": rets[i],
                "cumulative_return": sum(rets[:n]) / n,
                "rsi14": 100 - 100 / (1 + gain / max(loss, 1e-8)) if n >= 14 else np.nan,
            })
    return pd.DataFrame(out).sort_values(["symbol", "trade_date"]).reset_index(drop=True)


def sorted_pandas(df):
    return df.toPandas().sort_values(["symbol", "trade_date"]).reset_index(drop=True)


def in_pieces(n, series=BARS):
    """The series as it is, or cut into so many slices."""
    return replace(series, dated=n is None, pieces=n)


@pytest.mark.parametrize("pieces", [None, 1, 7, 150])
def test_indicators_equal_brute_force(spark, pieces):
    bars = random_bars(spark).withColumns({c: F.col("close") for c in ("open", "high", "low")}).cache()
    mine = sorted_pandas(I.indicators(bars, in_pieces(pieces)))
    theirs = brute(bars.toPandas())
    for c in theirs.columns[2:]:
        np.testing.assert_allclose(mine[c].astype(float), theirs[c], rtol=1e-9, atol=1e-9, err_msg=c)


@pytest.mark.parametrize("pieces", [None, 1, 40])
@pytest.mark.parametrize("period", [1, 2, 12, 300])
def test_ema_equals_recursion(spark, pieces, period):
    bars = random_bars(spark, seed=1).cache()
    mine = sorted_pandas(I.ema(bars, {"e": period}, series=in_pieces(pieces)))
    expected = mine.groupby("symbol").close.transform(lambda s: s.ewm(span=period, adjust=False).mean())
    np.testing.assert_allclose(mine.e, expected, rtol=1e-12)


def seconds(spark, n, nulls=False):
    values = np.random.default_rng(2).normal(100, 10, n)
    if nulls:
        values[[0, 1, 5, n // 2]] = np.nan
    pdf = pd.DataFrame({"symbol": "A", "ts": pd.date_range("2024-01-01", periods=n, freq="s"), "close": values})
    df = spark.createDataFrame(pdf).withColumn("close", F.when(~F.isnan("close"), F.col("close")))
    return df, pd.Series(values)


@pytest.mark.parametrize("pieces", [None, 1, 30])
def test_ema_of_long_slices(spark, pieces):
    """Far more values per slice than r^-i could take."""
    df, values = seconds(spark, 9000)
    series = in_pieces(pieces, Series(("symbol",), ("ts",)))
    lines = I.macd(I.ema(df, {"fast": 2, "slow": 50}, series=series), series=series).orderBy("ts").toPandas()
    e = {p: values.ewm(span=p, adjust=False).mean() for p in (2, 50, 12, 26)}
    np.testing.assert_allclose(lines.fast, e[2], rtol=1e-12)
    np.testing.assert_allclose(lines.slow, e[50], rtol=1e-12)
    line = e[12] - e[26]
    np.testing.assert_allclose(lines.macd, line, atol=1e-10)
    np.testing.assert_allclose(lines.signal, line.ewm(span=9, adjust=False).mean(), atol=1e-10)


def test_ema_skips_nulls(spark):
    df, values = seconds(spark, 900, nulls=True)
    for pieces in (None, 50):
        mine = I.ema(df, {"e": 7}, series=in_pieces(pieces, Series(("symbol",), ("ts",)))).orderBy("ts").toPandas()
        known = values.dropna().ewm(span=7, adjust=False).mean().reindex(values.index).ffill()
        np.testing.assert_allclose(mine.e, known, rtol=1e-12)


def test_macd_with_equal_periods(spark):
    bars = random_bars(spark, seed=3)
    mine = sorted_pandas(I.macd(bars, 5, 9, 9))
    s = mine[mine.symbol == "HOT"].close
    line = s.ewm(span=5, adjust=False).mean() - s.ewm(span=9, adjust=False).mean()
    np.testing.assert_allclose(
        mine[mine.symbol == "HOT"].signal, line.ewm(span=9, adjust=False).mean(), atol=1e-9
    )


def test_next_close_looks_forward_over_slices(spark):
    for pieces in (None, 30):
        mine = sorted_pandas(I.next_close(random_bars(spark), in_pieces(pieces), time="next_date"))
        whole = sorted_pandas(random_bars(spark))
        whole["close_next"] = whole.groupby("symbol").close.shift(-1)
        whole["next_date"] = whole.groupby("symbol").trade_date.shift(-1)
        whole = whole.dropna().reset_index(drop=True)
        assert mine.close_next.tolist() == whole.close_next.tolist()
        assert mine.next_date.tolist() == whole.next_date.tolist()


def test_replay_order_numbers_every_row(spark):
    df, _ = seconds(spark, 300)
    ticks = df.withColumn("event_id", F.monotonically_increasing_id()).drop("close")
    for pieces in (1, 60):
        steps = replay_order(ticks, replace(TICKS, pieces=pieces)).orderBy("ts").toPandas().step
        assert steps.tolist() == list(range(1, 301))


def test_a_hot_symbol_is_spread_over_slices(spark):
    """Nine tenths of the ticks in one symbol, many in one instant: slices stay even and copies few."""
    n = 20_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 10 > 0, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 7)).alias("symbol"),
        F.timestamp_seconds(F.least(F.col("id") % 5000, F.lit(3000))).alias("ts"), F.col("id").alias("event_id"),
        (F.col("id") % 13).alias("close"))
    past = with_past(rows, replace(TICKS, pieces=20), 5)
    sizes = [r["count"] for r in past.filter("symbol = 'HOT' and not _copied").groupBy("_slice").count().collect()]
    assert sum(sizes) == 18_000 and len(sizes) >= 10 and max(sizes) <= 3 * n / 20
    assert n <= past.count() <= 1.2 * n
    steps = replay_order(rows, replace(TICKS, pieces=20)).groupBy("symbol").agg(F.max("step").alias("a"), F.countDistinct("step").alias("b"))
    assert all(r.a == r.b for r in steps.collect())


def test_a_series_without_a_symbol_is_one_too(spark):
    df = spark.createDataFrame([(None, i, i, float(i)) for i in range(40)], "symbol string, ts long, event_id long, close double")
    for series in (replace(TICKS, pieces=8), Series(("symbol",), ("ts",))):
        assert I.sma(df, 3, series).filter("ma3 is not null").count() == 38
        last = I.ema(df, {"e": 3}, series=series).orderBy(F.desc("ts")).first().e
        assert last == pytest.approx(pd.Series(range(40)).ewm(span=3, adjust=False).mean().iloc[-1])


def test_total_volume_zero_and_close_zero(spark):
    rows = [("A", "1D", START + dt.timedelta(days=i), c, 0) for i, c in enumerate([5, 0, 7, 7])]
    df = spark.createDataFrame(rows, "symbol string, interval string, trade_date date, close bigint, volume bigint")
    vwap = I.vwap(df).orderBy("trade_date").toPandas().vwap
    assert vwap.tolist() == [0, 0, 0, 0]
    for pieces in (None, 4):
        series = in_pieces(pieces)
        returns = [r.daily_return for r in I.daily_return(df, series).orderBy("trade_date").collect()]
        assert returns == [0.0, -100.0, None, 0.0]
        means = [r.cumulative_return for r in I.running_mean_return(df, series).orderBy("trade_date").collect()]
        assert means == pytest.approx([0.0, -50.0, -50.0, -100 / 3])


def test_flat_and_rising_series(spark):
    def rsi(closes):
        rows = [("A", "1D", START + dt.timedelta(days=i), c) for i, c in enumerate(closes)]
        df = spark.createDataFrame(rows, "symbol string, interval string, trade_date date, close bigint")
        return [r.rsi14 for r in I.rsi(df).orderBy("trade_date").collect()]

    assert rsi([9] * 15)[12:] == [None, 0.0, 0.0]
    up = rsi(range(100, 115))
    assert up[13] == pytest.approx(100 - 100 / (1 + 13 / 14 / 1e-8)) and up[13] < 100
    assert up[14] == pytest.approx(99.999999)


def test_short_series_have_no_averages(spark):
    rows = [("A", "1D", START + dt.timedelta(days=i), i) for i in range(29)]
    df = spark.createDataFrame(rows, "symbol string, interval string, trade_date date, close bigint")
    assert I.sma(df.limit(6), 7).filter("ma7 is not null").count() == 0
    assert I.bollinger(df).filter("middle is not null or upper is not null").count() == 0


def test_bollinger_uses_the_population_deviation(spark):
    rows = [("A", "1D", START + dt.timedelta(days=i), i + 1) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, interval string, trade_date date, close bigint")
    last = I.bollinger(df).orderBy(F.desc("trade_date")).first()
    assert (last.middle, last.upper, last.lower) == pytest.approx((15.5, 32.810883, -1.810883))


# One symbol, 15 bars, worked out with exact fractions: fixed values.
CLOSE = [10, 11, 12, 11, 10, 10, 14, 13, 15, 16, 15, 17, 18, 17, 19]
VOLUME = [100, 200, 100, 300, 100, 100, 400, 200, 100, 100, 300, 200, 100, 100, 200]
VWAP = [10, 10.666667, 11, 11, 10.875, 10.777778, 11.769231, 11.933333, 12.125, 12.352941, 12.75,
        13.136364, 13.347826, 13.5, 13.923077]
CUMULATIVE = [0, 5, 6.363636, 2.689394, 0.333333, 0.277778, 5.952381, 4.315476, 5.545381, 5.657509,
              4.575008, 5.304869, 5.349291, 4.570373, 5.049995]
ONE_STEP = [None, 10.333333, 11.333333, 11.666667, 10.666667, 10, 11.333333, 13.666667, 13.666667,
            15.333333, 15.666667, 15.666667, 17.333333, 17.666667, 17.666667]
EMA5 = [10, 10.333333, 10.888889, 10.925926, 10.617284, 10.411523, 11.607682, 12.071788, 13.047859,
        14.031906, 14.354604, 15.236403, 16.157602, 16.438401, 17.292267]


def test_hand_worked_series(spark):
    rows = [("A", "1D", START + dt.timedelta(days=i), c, v) for i, (c, v) in enumerate(zip(CLOSE, VOLUME))]
    df = spark.createDataFrame(rows, "symbol string, interval string, trade_date date, close bigint, volume bigint")

    def column(result, name):
        return [r[name] for r in result.orderBy("trade_date").collect()]

    assert column(I.vwap(df), "vwap") == pytest.approx(VWAP, abs=1e-6)
    assert column(I.running_mean_return(df), "cumulative_return") == pytest.approx(CUMULATIVE, abs=1e-6)
    assert column(I.rsi(df), "rsi14")[13:] == pytest.approx([70.588235, 73.684211], abs=1e-6)
    one_step = column(I.ema_one_step(df), "ema")
    assert one_step[0] is None and one_step[1:] == pytest.approx(ONE_STEP[1:], abs=1e-6)
    assert column(I.ema(df, {"e": 5}), "e") == pytest.approx(EMA5, abs=1e-6)
    assert column(I.compound_return(df), "compound_return")[-1] == pytest.approx(90)

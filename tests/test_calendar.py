"""Days a market should have traded, gaps of series, and the gate before training."""

import datetime as dt

from candles.functions import columns as C
from candles.operators import calendar as CAL
from candles.operators import quality as Q
from candles.plans import jobs
from candles.sources import sinks

BAR = "symbol string, interval string, trade_date date, open double, high double, low double, close double, volume bigint"
MONDAY = dt.date(2024, 1, 1)


def frame(spark, days, interval="1D"):
    """Bars of (symbol, day number from a Monday)."""
    return spark.createDataFrame(
        [(s, interval, MONDAY + dt.timedelta(days=d), 1.0, 1.0, 1.0, 1.0, 1) for s, d in days], BAR)


def weekdays(n, off=()):
    return [d for d in range(n) if d % 7 < 5 and d not in off]


def test_an_absent_weekday_is_a_market_day_and_a_weekend_is_not(spark):
    df = frame(spark, [("A", d) for d in weekdays(28, off=(9, 10))])
    days = {(r.trade_date - MONDAY).days: (r.place, r.traded) for r in CAL.market_days(df).collect()}
    assert list(sorted(days)) == weekdays(28)
    assert days[9] == (8, False) and days[11] == (10, True)
    assert [r.trade_date for r in CAL.absent_days(df, ["2024-01-10"]).collect()] == [MONDAY + dt.timedelta(days=10)]
    assert not Q.is_complete(df, 1) and Q.is_complete(df, 1, holidays=["2024-01-10", "2024-01-11"])


def test_intervals_have_calendars_of_their_own(spark):
    df = frame(spark, [("A", d) for d in weekdays(28)]).unionByName(frame(spark, [("A", d) for d in (6, 13, 27)], "1W"))
    absent = [(r.interval, (r.trade_date - MONDAY).days) for r in CAL.absent_days(df).collect()]
    assert absent == [("1W", 20)]


def test_islands_and_their_days(spark):
    rows = [("A", d) for d in weekdays(28)] + [("B", d) for d in weekdays(28, off=(3, 4, 7, 15))] + [("C", 2), ("C", 2), ("C", 21)]
    df = frame(spark, rows)
    islands = sorted((r.symbol, (r.first_day - MONDAY).days, (r.last_day - MONDAY).days, r.days) for r in CAL.outage_islands(df).collect())
    assert islands == [("B", 3, 7, 3), ("B", 15, 15, 1), ("C", 3, 18, 12)]
    missing = sorted((r.symbol, (r.trade_date - MONDAY).days) for r in CAL.missing_days(df).collect())
    assert missing == [("B", d) for d in (3, 4, 7, 15)] + [("C", d) for d in weekdays(21)[3:]]
    assert CAL.outage_islands(df, least=3).count() == 2
    ends = CAL.outage_islands(df, least=1, to_end=True).where("symbol = 'C' and days = 4").collect()
    assert [((r.first_day - MONDAY).days, (r.last_day - MONDAY).days) for r in ends] == [(22, 25)]


def test_no_rows(spark):
    empty = frame(spark, [("A", 1)]).limit(0)
    assert CAL.market_days(empty).count() == 0 == CAL.missing_days(empty).count() and not Q.is_complete(empty, 1)


def test_training_gate_asks_for_the_marker_of_the_run(spark, tmp_path):
    import os

    path = f"{tmp_path}/bars"
    assert not jobs.training_gate(spark, path, 1)
    sinks.write_bars(C.with_month(frame(spark, [(s, d) for s in "AB" for d in weekdays(28)])), path)
    assert jobs.training_gate(spark, path, 2) and not jobs.training_gate(spark, path, 3)
    os.remove(f"{path}/_SUCCESS")
    assert not jobs.training_gate(spark, path, 2)

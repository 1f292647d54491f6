"""Late and corrected bars, suspended symbols, and bars below a day, from landing to the indicators."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from candles import schemas
from candles.functions import columns as C
from candles.operators import incremental as INC
from candles.plans import jobs
from candles.sources import readers, sinks

BAR = "symbol string, interval string, trade_date date, open double, high double, low double, close double, volume bigint"
DAY0 = dt.date(2023, 1, 2)


def bar(symbol, day, close):
    return (symbol, "1D", DAY0 + dt.timedelta(days=day), close, close + 1, close - 1, close, 10)


def frame(spark, rows):
    return C.with_month(spark.createDataFrame(rows, BAR))


def whole(view):
    return sorted(tuple(round(x, 8) if isinstance(x, float) else x for x in r) for r in view.collect())


def months(df):
    """Months of the rows of a frame."""
    return {r.month for r in df.select("month").distinct().collect()}


class Market:
    """A table of bars and the view over it."""

    def __init__(self, spark, root):
        self.spark, self.path, self.view = spark, f"{root}/bars", f"{root}/view"

    def upsert(self, rows):
        sinks.upsert(frame(self.spark, rows), self.path, schemas.BAR_KEY)

    def bars(self):
        return readers.read_bars(self.spark, self.path, frame(self.spark, [bar("x", 0, 1.0)]).schema)

    def stored(self):
        return self.spark.read.parquet(self.view)

    def fresh(self, root):
        jobs.run_analyst(self.bars(), f"{root}/fresh")
        return self.spark.read.parquet(f"{root}/fresh"), self.spark.read.parquet(f"{root}/fresh.state")


@pytest.fixture
def market(spark, tmp_path):
    return Market(spark, str(tmp_path))


def test_corrected_and_late_bars_reach_the_indicators(market, spark, tmp_path):
    rows = {(s, d): bar(s, d, 100.0 + (7 * d + ord(s)) % 13) for s in "ABC" for d in range(0, 300, 1 + (s == "C"))}
    late = {("A", 200), ("B", 0), ("B", 1)}
    market.upsert([r for k, r in rows.items() if k not in late])
    jobs.run_analyst(market.bars(), market.view)
    fixed = {("A", 250): bar("A", 250, 55.0), ("B", 120): bar("B", 120, 66.0), ("A", 200): rows["A", 200],
             ("B", 0): rows["B", 0], ("B", 1): rows["B", 1], ("NEW", 280): bar("NEW", 280, 5.0)}
    market.upsert(list(fixed.values()))
    changed = INC.changed_rows(market.bars(), market.stored(), schemas.BAR_KEY, schemas.PRICE_COLUMNS)
    assert changed.count() == len(fixed)
    jobs.run_corrections(changed, market.bars(), market.view)
    view, state = market.fresh(tmp_path)
    assert whole(market.stored()) == whole(view.select(*market.stored().columns))
    kept = spark.read.parquet(f"{market.view}.state")
    assert whole(kept) == whole(state.select(*kept.columns))
    # Runs after it go on from what was corrected.
    market.upsert([bar(s, 301, 120.0) for s in "ABC"])
    jobs.run_analyst(market.bars(), market.view)
    again = Market(spark, str(tmp_path))
    jobs.run_analyst(again.bars(), f"{tmp_path}/third")
    assert whole(market.stored()) == whole(spark.read.parquet(f"{tmp_path}/third").select(*market.stored().columns))


def test_corrections_read_the_months_they_touch(market, spark, monkeypatch):
    market.upsert([bar(s, d, 100.0 + d % 9) for s in "AB" for d in range(600)])
    jobs.run_analyst(market.bars(), market.view)
    market.upsert([bar("A", 590, 50.0)])
    before = {r.month for r in market.bars().select("month").distinct().collect()}
    seen = []
    view_of = jobs._view_of
    monkeypatch.setattr(jobs, "_view_of", lambda df, series: seen.append(months(df)) or view_of(df, series))
    changed = frame(spark, [bar("A", 590, 50.0)])
    jobs.run_corrections(changed, market.bars(), market.view)
    assert seen == [{"2024-08"}] and len(before) == 20
    with pytest.raises(ValueError, match="no view"):
        jobs.run_corrections(changed, market.bars(), f"{market.view}-none")


def test_a_suspended_symbol_costs_no_months(market, spark, monkeypatch):
    market.upsert([bar("OLD", d, 9.0) for d in range(20)] + [bar(s, d, 100.0 + d % 9) for s in "AB" for d in range(400)])
    jobs.run_analyst(market.bars(), market.view)
    market.upsert([bar(s, d, 80.0) for s in "AB" for d in range(400, 410)])
    seen, view_of = [], jobs._view_of
    monkeypatch.setattr(jobs, "_view_of", lambda df, series: seen.append(months(df)) or view_of(df, series))
    jobs.run_analyst(market.bars(), market.view)
    assert seen == [{"2024-02"}]
    assert market.stored().count() == 840
    chart = jobs.candlestick(market.bars(), months=2)
    plan = chart._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2023-01" in plan and "2024-02" in plan and "2023-07" not in plan
    days = {r.symbol: r.n for r in chart.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert days["OLD"] == 20 and 55 < days["A"] < 65


def minute(i, crawl, close=10.0, told=True, interval="1m"):
    at = {"bar_time": f"2024-12-20T09:{15 + i}:00"} if told else {}
    return (json.dumps({
        "symbol": "FPT", "interval": interval, "event_date": "2024-12-20", "event_time": crawl, "source": "x", **at,
        "data": {"open": close, "high": close, "low": close, "close": close, "volume": 5}}), i)


@pytest.mark.parametrize("told", [True, False])
def test_bars_of_one_crawl_are_all_kept(spark, tmp_path, told):
    """All five have the time of their crawl; the fourth and the fifth agree in all prices."""
    def land(crawl, closes):
        events = spark.createDataFrame([minute(i, crawl, c, told) for i, c in enumerate(closes)], "value string, offset bigint")
        assert jobs.land_ohlcv(events, f"{tmp_path}/bars") == 0
        return sorted(r.close for r in spark.read.parquet(f"{tmp_path}/bars").collect())

    closes = [10.0, 11.0, 12.0, 13.0, 13.0]
    assert land("2024-12-20T15:00:00Z", closes) == closes
    assert land("2024-12-21T15:00:00Z", closes) == closes
    revised = land("2024-12-22T15:00:00Z", [10.0, 11.0, 12.0, 13.0, 14.0])
    assert revised == ([10.0, 11.0, 12.0, 13.0, 14.0] if told else [10.0, 11.0, 12.0, 13.0, 13.0, 14.0])


def test_bars_below_a_day_in_the_views(spark, tmp_path):
    events = spark.createDataFrame([minute(i, "c", 10.0 + i) for i in range(40)] + [minute(0, "c", told=False)], "value string, offset bigint")
    jobs.land_ohlcv(events, f"{tmp_path}/bars")
    landed = readers.read_bars(spark, f"{tmp_path}/bars")
    for part in (landed.where("bar_time < '2024-12-20T09:40:00'"), landed, landed):
        jobs.run_daily(part, f"{tmp_path}/daily", jobs.INTRADAY)
        jobs.run_analyst(part, f"{tmp_path}/view", jobs.INTRADAY)
    daily = spark.read.parquet(f"{tmp_path}/daily").orderBy("bar_at").collect()
    assert len(daily) == 40 and daily[0].es_id == "FPT_1m_2024-12-20 09:15:00"
    view = spark.read.parquet(f"{tmp_path}/view").orderBy("bar_at").collect()
    assert len(view) == 40 == len({r.es_id for r in view})
    assert [r.ma7 for r in view[:8]] == [None] * 6 + [13.0, 14.0] and view[-1].ma30 == sum(range(20, 50)) / 30

"""The physical plans a large cluster depends on."""

import re

from candles.functions.columns import with_month
from candles.operators import bars as B
from candles.operators import indicators as I
from candles.operators import quality as Q
from candles.operators.incremental import replace_latest
from candles.operators.series import TICKS
from candles.plans import jobs
from candles.sources import sinks
from candles.sources.tables import bars, ticks

FOLDER = "/root/testdata/sf0.001"


def run_plan(df):
    """The final adaptive plan, without the initial one."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, tmp_path):
    path = str(tmp_path / "bars")
    sinks.write_bars(with_month(bars(spark, FOLDER)), path)
    return spark.read.parquet(path)


def test_indicators_of_bars_shuffle_and_sort_once(spark, tmp_path):
    plan = run_plan(I.indicators(stored(spark, tmp_path).drop("month")))
    assert plan.count("Exchange hashpartitioning") == 1
    assert len(re.findall(r"[+*:| -]Sort(?: \(| \[)", plan)) == 1


def test_windows_never_lack_a_slice(spark):
    plan = first_plan(I.sma(ticks(spark, FOLDER).withColumnRenamed("price", "close"), 20, TICKS))
    row_windows = [line for line in plan.splitlines() if "windowspecdefinition" in line and "event_id" in line]
    assert row_windows and all("_slice" in line for line in row_windows)


def test_latest_rows_are_limited_before_the_shuffle(spark):
    df = bars(spark, FOLDER)
    for result in (
        Q.dedup_latest(df, order=["volume"]),
        replace_latest(df, df),
        B.newest(df, 2),
        B.intraday_page(ticks(spark, FOLDER), "2024-01-05"),
    ):
        plan = first_plan(result)
        assert re.search(r"WindowGroupLimit.*Partial", plan), plan


def test_aggregates_are_partial_before_the_shuffle(spark):
    df = bars(spark, FOLDER)
    for result in (B.resample(df, "1W"), B.price_summary(df), B.candles(ticks(spark, FOLDER), "1 hour"),
                   Q.completeness(df, 5), B.latest_date(df)):
        assert "partial_" in first_plan(result)


def test_candlestick_prunes_folders_and_pushes_filters(spark, tmp_path):
    df = stored(spark, tmp_path)
    chart = jobs.candlestick(df, "S1", end="1996-12-31").select("trade_date", "close")
    plan = first_plan(chart)
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\], ReadSchema: (.*)", plan)
    assert "month" in filters[1]
    assert "EqualTo(symbol,S1)" in filters[2] and "GreaterThan(trade_date" in filters[2]
    assert "open" not in filters[3] and "volume" not in filters[3]


def test_history_prunes_folders(spark, tmp_path):
    plan = first_plan(B.history(stored(spark, tmp_path), None, "1996-01-01", "1997-01-01", "1D"))
    filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan)[1]
    assert "month" in filters and "interval" in filters


def test_rankings_take_ordered_rows(spark):
    assert "TakeOrderedAndProject" in first_plan(jobs.search(bars(spark, FOLDER)))


def test_no_plan_broadcasts_by_hint_or_joins_without_keys(spark):
    from candles.plans.queries import QUERIES

    for name, query in QUERIES.items():
        if name.startswith(("stream_", "land_", "ml_metrics", "scan_", "upsert", "compaction", "csv")):
            continue
        df = query(spark, FOLDER)
        assert "CartesianProduct" not in first_plan(df), name
        assert "BroadcastNestedLoopJoin" not in first_plan(df), name
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString(), name


def test_events_are_parsed_once(spark):
    from candles.functions import events as E

    raw = spark.createDataFrame([("{}",)], "value string")
    plan = first_plan(E.stock_bars(raw).filter("trade_date is not null and symbol is not null"))
    assert plan.count("from_json") == 1

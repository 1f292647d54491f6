"""Parsing, quality, tables, landing, incremental runs and prediction on small inputs."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from candles import schemas
from candles.functions import columns as C
from candles.functions import events as E
from candles.operators import bars as B
from candles.operators import incremental as INC
from candles.operators import indicators as I
from candles.operators import quality as Q
from candles.plans import jobs, predict
from candles.session import scratch, scratch_root
from candles.sources import readers, sinks

D = dt.date
BAR = "symbol string, interval string, trade_date date, open double, high double, low double, close double, volume bigint"


def bar(symbol, day, close=10.0, volume=1, interval="1D"):
    return (symbol, interval, day, close, close + 1, close - 1, close, volume)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), BAR)


def event(symbol="FPT", day="2024-12-20", volume=2500000, time="2024-12-20T00:00:00Z", close=121.5):
    return json.dumps({
        "event_type": "ohlcv", "symbol": symbol, "interval": "1D", "event_date": day, "event_time": time,
        "source": "x", "data": {"open": 120.5, "high": 122.0, "low": 119.8, "close": close, "volume": volume},
    })


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_malformed_events_are_told_apart(spark):
    raw = values(spark, event(), "{not json", event()[:60])
    parsed = E.parse_json(raw, schemas.STOCK_EVENT)
    assert E.valid(parsed).count() == 1 and E.corrupt(parsed).count() == 2
    rows = E.stock_bars(raw).collect()
    assert [r.symbol for r in rows] == ["FPT", None, None]
    assert rows[0].trade_date == D(2024, 12, 20) and rows[0].volume == 2500000


def test_bytes_are_read_like_text(spark):
    raw = values(spark, event()).select(F.col("value").cast("binary"))
    assert E.stock_bars(raw).first().close == 121.5


def test_intraday_volume_may_be_a_float_or_large(spark):
    text = '{"time": "2024-12-20 09:15:00", "symbol": "FPT", "open": 1, "high": 2, "low": 1, "close": 2, "volume": %s}'
    rows = E.intraday_bars(values(spark, text % "2500.0", text % "3000000000", text.replace("09:15", "bad") % "1"))
    got = rows.orderBy("volume").collect()
    assert [r.volume for r in got] == [1, 2500, 3000000000]
    assert got[0].time is None and got[1].time == dt.datetime(2024, 12, 20, 9, 15)


def test_index_events_round_trip(spark):
    df = frame(spark, bar("VNINDEX", D(2024, 12, 20))).withColumnRenamed("symbol", "index_code")
    records = E.to_kafka_records(E.to_index_events(df, "x", "2024-12-21T00:00:00Z"), "t", "index_code")
    row = E.index_bars(records).first()
    assert records.first().key == "VNINDEX" and records.first().topic == "t"
    assert (row.index_code, row.year, row.event_month, row.close) == ("VNINDEX", 2024, 12, 10.0)
    assert E.to_kafka_records(df, "t").first().key is None


@pytest.mark.parametrize("kind, value", [
    ("bigint", 1734652800000), ("string", "2024-12-20"), ("date", D(2024, 12, 20)),
    ("timestamp", dt.datetime(2024, 12, 20, 15)), ("timestamp_ntz", dt.datetime(2024, 12, 20, 15)),
])
def test_any_date_becomes_a_date(spark, kind, value):
    df = spark.createDataFrame([(value,)], f"trade_date {kind}")
    assert C.normalize_date(df).first().trade_date == D(2024, 12, 20)


def test_dates_that_are_none(spark):
    df = spark.createDataFrame([("bad",), ("2024-02-30",), ("2024-02-29",)], "trade_date string")
    assert [r.trade_date for r in C.coerce_dates(df).collect()] == [D(2024, 2, 29)]
    with pytest.raises(ValueError):
        C.normalize_date(spark.createDataFrame([(1.5,)], "trade_date double"))


def test_row_keys_are_never_shortened(spark):
    df = frame(spark, bar("A", D(2024, 1, 2)), bar(None, D(2024, 1, 2)))
    keys = [r[0] for r in df.select(C.row_key("symbol", "interval", "trade_date")).collect()]
    assert keys == ["A_1D_2024-01-02", None]


def test_small_columns(spark):
    row = spark.range(1).select(
        C.clean_symbol(F.lit(" fpt ")).alias("s"), C.lookback("2024-03-01", days=365).alias("a"),
        C.lookback("2024-03-01", years=3).alias("b"), C.millis_text(F.lit(1734652800000)).alias("t"),
    ).first()
    assert tuple(row) == ("FPT", D(2023, 3, 2), D(2021, 3, 1), "2024-12-20")
    df = spark.createDataFrame([(1, 2)], "date int, close int")
    assert C.with_time_column(df).columns == ["time", "close"]
    with pytest.raises(ValueError):
        C.detect_time_column(df.drop("date"))


def test_sessions_and_bad_bars(spark):
    at = [dt.datetime(2024, 1, 2, 14, 59, 59), dt.datetime(2024, 1, 2, 15)]
    df = spark.createDataFrame([(t, 1.0, None) for t in at], "ts timestamp, close double, volume bigint")
    kept = Q.session_filter(Q.drop_bad_bars(df, ("close",)), 15).collect()
    assert [r.ts for r in kept] == at[:1]


def test_weeks_end_on_sunday(spark):
    df = frame(spark, bar("A", D(2024, 12, 22), 5.0), bar("A", D(2024, 12, 23), 6.0), bar("A", D(2024, 12, 24), 7.0))
    weeks = B.resample(df, "1W").orderBy("period_end").collect()
    assert [(r.period_end, r.open, r.close, r.volume) for r in weeks] == [
        (D(2024, 12, 22), 5.0, 5.0, 1), (D(2024, 12, 29), 6.0, 7.0, 2)]
    assert B.resample(df, "1D") is df
    with pytest.raises(ValueError):
        B.resample(df, "5m")


def test_resample_skips_missing_prices(spark):
    df = spark.createDataFrame(
        [("A", "1D", D(2024, 1, 1), None, 2.0, 1.0, 5.0, 1), ("A", "1D", D(2024, 1, 2), 3.0, 4.0, 1.0, None, None),
         ("B", "1D", D(2024, 1, 1), None, 2.0, 1.0, 5.0, 1)],
        "symbol string, interval string, trade_date date, open double, high double, low double, close double, volume bigint")
    assert [tuple(r) for r in B.resample(df, "1M").collect()] == [("A", D(2024, 1, 31), 3.0, 4.0, 1.0, 5.0, 1)]


def test_candles_keep_low_and_high_around_open_and_close(spark):
    from candles.sources.tables import ticks

    candles = B.candles(ticks(spark, "/root/testdata/sf0.001"), "1 hour")
    assert candles.filter("low > least(open, close) or high < greatest(open, close)").count() == 0
    total = ticks(spark, "/root/testdata/sf0.001").agg(F.sum("volume")).first()[0]
    assert candles.agg(F.sum("volume")).first()[0] == total


def test_weekly_volume_adds_up(spark):
    from candles.sources.tables import bars

    df = bars(spark, "/root/testdata/sf0.001")
    for interval in ("1W", "1M"):
        assert B.resample(df, interval).agg(F.sum("volume")).first() == df.agg(F.sum("volume")).first()


def test_dedup_of_one_hot_key(spark):
    """A third of all rows are copies of one bar."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id"))).alias("symbol"),
        F.lit("1D").alias("interval"), F.lit(D(2024, 1, 1)).alias("trade_date"), F.col("id").alias("event_time"),
    )
    kept = Q.dedup_latest(df)
    assert kept.count() == 2001
    assert kept.filter("symbol = 'HOT'").first().event_time == 2997


def test_completeness_gate(spark):
    df = frame(spark, bar("A", D(2024, 1, 1)), bar("B", D(2024, 1, 1)), bar("A", D(2024, 1, 2)))
    assert Q.is_complete(df, 1) and not Q.is_complete(df, 2) and not Q.is_complete(df.limit(0), 1)


def test_coverage_totals(spark):
    df = frame(spark, bar("A", D(2024, 1, 1)), bar("A", D(2024, 1, 2)))
    wanted = spark.createDataFrame([("A",), ("B",)], "symbol string")
    totals = {r.status: (r.symbols, r.n) for r in Q.coverage_totals(Q.coverage(df, wanted)).collect()}
    assert totals == {"success": (1, 2), "no_data": (1, 0)}


def test_reports_of_unknown_type_are_rejected(spark):
    with pytest.raises(ValueError):
        B.report_head(spark.range(1), 3, "Horoscope")


def test_pages_of_one_symbol(spark):
    from candles.sources.tables import ticks

    page = B.intraday_page(ticks(spark, "/root/testdata/sf0.001"), "2024-01-05", 3, "click").collect()
    assert len(page) == 3 and page == sorted(page, key=lambda r: r.ts)


# Tables


def test_interval_folders_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_bars(frame(spark, bar("FPT", D(2024, 12, 20))), path, ["symbol", "interval", "trade_date"])
    assert os.path.isdir(f"{path}/symbol=FPT/interval=1D/trade_date=2024-12-20")
    row = jobs.daily_view(readers.read_bars(spark, path)).first()
    assert row.interval == "1D" and row.es_id == "FPT_1D_2024-12-20"


def test_upsert_twice_is_once_and_leaves_other_months_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    old = C.with_month(frame(spark, bar("A", D(2024, 1, 1)), bar("A", D(2024, 2, 1)), bar("B", D(2024, 2, 1))))
    new = C.with_month(frame(spark, bar("A", D(2024, 2, 1), 20.0), bar("C", D(2024, 2, 2), 30.0)))
    sinks.upsert(old, path, schemas.BAR_KEY)
    january = {f: os.path.getmtime(f"{path}/interval=1D/month=2024-01/{f}") for f in os.listdir(f"{path}/interval=1D/month=2024-01")}
    for _ in range(2):
        sinks.upsert(new, path, schemas.BAR_KEY)
        rows = readers.read_bars(spark, path).orderBy("trade_date", "symbol").collect()
        assert [(r.symbol, r.close) for r in rows] == [("A", 10.0), ("A", 20.0), ("B", 10.0), ("C", 30.0)]
    assert january == {f: os.path.getmtime(f"{path}/interval=1D/month=2024-01/{f}") for f in january}


def test_upsert_of_some_folders(spark, tmp_path):
    path = str(tmp_path / "t")
    old = C.with_month(frame(spark, *[bar("A", D(2024, m, 1)) for m in range(1, 7)]))
    sinks.upsert(old, path, schemas.BAR_KEY)
    sinks.upsert(old.filter("month > '2024-03'").withColumn("close", F.lit(20.0)), path, schemas.BAR_KEY)
    closes = [r.close for r in readers.read_bars(spark, path).orderBy("trade_date").collect()]
    assert closes == [10.0] * 3 + [20.0] * 3


def test_an_older_event_does_not_replace_a_newer_one(spark, tmp_path):
    path = str(tmp_path / "t")
    jobs.land_ohlcv(values(spark, event(time="2024-12-20T09:00:00Z", close=2.0), "junk"), path)
    jobs.land_ohlcv(values(spark, event(time="2024-12-20T08:00:00Z", close=1.0)), path)
    assert [r.close for r in readers.read_bars(spark, path).collect()] == [2.0]
    jobs.land_ohlcv(values(spark, event(time="2024-12-20T10:00:00Z", close=3.0)), path)
    assert [r.close for r in readers.read_bars(spark, path).collect()] == [3.0]


def test_upsert_refuses_to_lose_columns_or_guess_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = C.with_month(frame(spark, bar("A", D(2024, 1, 1)))).withColumn("source", F.lit("x"))
    sinks.upsert(df, path, schemas.BAR_KEY)
    with pytest.raises(ValueError, match="source"):
        sinks.upsert(df.drop("source"), path, schemas.BAR_KEY)
    with pytest.raises(ValueError, match="repeats"):
        sinks.upsert(df.unionByName(df), path, schemas.BAR_KEY)
    sinks.upsert(df.withColumn("more", F.lit(1)), path, schemas.BAR_KEY)
    assert spark.read.parquet(path).first().source == "x"


def test_compaction_refuses_to_choose_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_bars(C.with_month(frame(spark, bar("A", D(2024, 1, 1)), bar("B", D(2024, 1, 1)))), path)
    with pytest.raises(ValueError, match="partition"):
        jobs.compact(spark, path, sinks.BAR_PARTITIONS, "symbol = 'A'")
    assert spark.read.parquet(path).count() == 2


def test_scratch_is_left_empty(spark, tmp_path):
    before = set(os.listdir(scratch_root(spark)))
    path = str(tmp_path / "t")
    for _ in range(2):
        sinks.upsert(C.with_month(frame(spark, bar("A", D(2024, 1, 1)))), path, schemas.BAR_KEY)
    jobs.compact(spark, path, sinks.BAR_PARTITIONS)
    assert set(os.listdir(scratch_root(spark))) == before


def test_events_that_cannot_be_landed_are_kept_and_counted(spark, tmp_path):
    path = str(tmp_path / "t")
    raw = values(spark, event(), "junk", "junk", event(day="soon"), event(volume="many", day="2024-12-21"), '{"interval": "1D"}')
    for _ in range(2):
        assert jobs.land_ohlcv(raw, path) == 3
    rows = readers.read_bars(spark, path).orderBy("trade_date").collect()
    assert [(r.trade_date.day, r.volume, r.close) for r in rows] == [(20, 2500000, 121.5), (21, None, 121.5)]
    refused = spark.read.parquet(f"{path}.rejected").collect()
    assert sorted(r.reason for r in refused) == ["no date", "no symbol", "not json"]


def test_the_place_in_the_source_breaks_ties(spark, tmp_path):
    path = str(tmp_path / "t")
    raw = spark.createDataFrame([(event(close=9.0), 1), (event(close=2.0), 2)], "value string, offset long")
    jobs.land_ohlcv(raw, path)
    assert [r.close for r in readers.read_bars(spark, path).collect()] == [2.0]


def test_compaction_leaves_one_file_per_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    df = C.with_month(frame(spark, *[bar("A", D(2024, 1, d)) for d in range(1, 29)], bar("A", D(2024, 2, 1))))
    for _ in range(3):
        df.repartition(5).write.mode("append").partitionBy(*sinks.BAR_PARTITIONS).parquet(path)
    before = readers.folder_summary(spark, path, ".parquet").orderBy("folder").collect()
    jobs.compact(spark, path, sinks.BAR_PARTITIONS, "month = '2024-01'")
    after = readers.folder_summary(spark, path, ".parquet").orderBy("folder").collect()
    assert [r.folder for r in after] == ["month=2024-01", "month=2024-02"]
    assert before[0].files > 5 and after[0].files == 1 and after[1].files == before[1].files
    assert readers.read_bars(spark, path).count() == 3 * 29


def test_csv_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "col1 int, col2 string")
    path = str(tmp_path / "out")
    assert sinks.write_many({"x": df, "none": df.limit(0), "nothing": None}, path) == {
        "x": True, "none": False, "nothing": False}
    assert readers.read_csv(spark, f"{path}/x", df.schema).orderBy("col1").collect() == df.collect()
    assert readers.read_csv(spark, f"{path}/missing", df.schema) is None
    marked = tmp_path / "bom.csv"
    marked.write_bytes("﻿col1,col2\n7,é\n".encode())
    assert [tuple(r) for r in readers.read_csv(spark, str(marked), df.schema).collect()] == [(7, "é")]
    assert [r.filename for r in readers.list_files(spark, str(tmp_path)).collect()] == ["bom.csv"]
    info = readers.file_info(spark, str(tmp_path), ".csv").first()
    assert info.filename == "bom.csv" and info.size_kb == round(marked.stat().st_size / 1024, 2)


def test_scratch_is_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root and scratch(spark, "x").startswith(root)
    assert scratch(spark, "x") != scratch(spark, "x")


# Incremental runs


def test_full_history_equals_a_full_run(spark):
    bars = frame(spark, *[bar("A", D(2024, 1, 1) + dt.timedelta(days=i), 10.0 + i % 7) for i in range(60)])
    stored = bars.filter("trade_date < '2024-02-10'")
    whole = I.indicators(bars).filter("trade_date >= '2024-02-10'").orderBy("trade_date").collect()
    for policy in ("anti", "max_date"):
        fresh = jobs.analyst(bars, stored, "full", policy).select(*whole[0].__fields__)
        assert fresh.orderBy("trade_date").collect() == whole
    view = jobs.analyst(stored, None)
    for cut in ("2024-02-10", "2024-01-04"):  # more rows than a frame takes, and fewer
        part = jobs.analyst(bars.filter(F.col("trade_date") < cut), None)
        rest = jobs.analyst(bars, part, "continue").orderBy("trade_date")
        expected = I.indicators(bars, so_far=True).filter(F.col("trade_date") >= cut).orderBy("trade_date")
        for mine, theirs in zip(rest.collect(), expected.select(*rest.columns).collect(), strict=True):
            assert tuple(mine) == pytest.approx(tuple(theirs))
    assert jobs.analyst(bars, view, "continue").count() == len(whole)
    restarted = jobs.analyst(bars, stored, "new_only").orderBy("trade_date").collect()
    assert restarted[0].daily_return == 0.0 and restarted[5].ma7 is None and restarted[6].ma7 is not None
    assert jobs.analyst(bars, None).count() == 60


def test_late_rows_are_found_by_key_but_not_by_date(spark):
    bars = frame(spark, *[bar("A", D(2024, 1, d)) for d in (1, 2, 3)], bar("B", D(2024, 1, 1)))
    stored = bars.filter("symbol = 'A' and trade_date <> '2024-01-02'")
    assert INC.new_rows(bars, stored, "anti").count() == 2
    assert [r.symbol for r in INC.new_rows(bars, stored, "max_date").collect()] == ["B"]
    with pytest.raises(ValueError):
        INC.new_rows(bars, stored, "hope")


def test_top_movers_of_a_single_bar(spark):
    df = frame(spark, bar("A", D(2024, 1, 2)), bar("B", D(2024, 1, 1)), bar("B", D(2024, 1, 2), 11.0),
               bar("C", D(2024, 1, 1), 0.0), bar("C", D(2024, 1, 2), 1.0), bar("OLD", D(2023, 1, 1)), bar("OLD", D(2023, 1, 2), 90.0),
               bar("B", D(2024, 1, 7), 99.0, interval="1W"))
    assert [tuple(r) for r in jobs.top_movers(df, "top_gain", as_of="2024-01-05").orderBy("rank").collect()] == [
        (1, "B", pytest.approx(10.0)), (2, "A", 0.0)]
    with pytest.raises(ValueError):
        jobs.top_movers(df, "top_secret")


def test_a_second_analyst_run_reads_new_months_only(spark, tmp_path):
    path = str(tmp_path / "bars")
    df = C.with_month(frame(spark, *[bar(s, D(2024, m, d), 10.0 + d, d) for s in "AB" for m in (1, 2, 3) for d in (1, 9)]))
    sinks.write_bars(df.filter("month < '2024-03'"), path)
    jobs.run_analyst(readers.read_bars(spark, path, df.schema), f"{path}-view")
    january = os.listdir(f"{path}-view/interval=1D/month=2024-01")
    sinks.write_bars(df.filter("month = '2024-03'"), path)
    for _ in range(2):
        jobs.run_analyst(readers.read_bars(spark, path, df.schema), f"{path}-view")
    assert os.listdir(f"{path}-view/interval=1D/month=2024-01") == january
    names = ["symbol", "trade_date", "vwap", "cumulative_return", "daily_return"]
    of = lambda view: sorted((*r[:2], *[round(x, 9) for x in r[2:]]) for r in view.select(*names).collect())
    assert of(spark.read.parquet(f"{path}-view")) == of(I.indicators(df.drop("month")))


def test_a_series_new_in_a_later_run_keeps_its_whole_history(spark, tmp_path):
    path = str(tmp_path / "bars")
    old = [bar("A", D(2024, m, d), 10.0 + d, d) for m in (2, 3) for d in (1, 9)]
    new = [bar(s, D(y, m, d), 20.0 + d, m) for s, y, months in (("NEW", 2023, (11, 12)), ("NEW", 2024, (2, 3, 4)), ("GONE", 2023, (5, 6)))
           for m in months for d in (2, 8)]
    later = [bar("A", D(2024, 4, 1), 15.0, 3)]
    sinks.write_bars(C.with_month(frame(spark, *old)), path)
    df = C.with_month(frame(spark, *old, *new, *later))
    jobs.run_analyst(readers.read_bars(spark, path, df.schema), f"{path}-view")
    sinks.write_bars(C.with_month(frame(spark, *new, *later)), path)
    for _ in range(2):
        jobs.run_analyst(readers.read_bars(spark, path, df.schema), f"{path}-view")
    names = ["symbol", "trade_date", "vwap", "cumulative_return", "daily_return"]
    of = lambda view: sorted((*r[:2], *[round(x, 9) for x in r[2:]]) for r in view.select(*names).collect())
    assert of(spark.read.parquet(f"{path}-view")) == of(I.indicators(df.drop("month")))


# Prediction


def test_embargo_drops_only_the_row_before_the_cut(spark):
    bars = frame(spark, *[bar("A", D(2024, 1, d)) for d in (1, 2, 3, 4)], *[bar("B", D(2024, 1, d)) for d in (1, 2)])
    labelled = predict.labelled(bars)
    train, test = predict.time_split(labelled, "2024-01-03")
    assert train.count() == 3 and test.count() == 1
    assert {(r.symbol, r.trade_date.day) for r in predict.time_split(labelled, "2024-01-03", 1)[0].collect()} == {
        ("A", 1), ("B", 1)}


def test_models_learn_a_line(spark):
    bars = frame(spark, *[bar("A", D(2024, 1, 1) + dt.timedelta(days=i), 100.0 + i, i % 5) for i in range(80)])
    scores = {(r.model, r.metric): r.value for r in predict.train_and_score(bars, "2024-03-01", "A", trees=5).collect()}
    assert scores["linear", "rmse"] < 0.1 and scores["linear", "r2"] > 0.99
    assert scores["forest", "rmse"] > scores["linear", "rmse"]


def test_counting_rides_along(spark, tmp_path):
    df, seen = Q.counted(spark.range(7))
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get["n"] == 7


def test_incomplete_days_are_not_trained_on(spark):
    with pytest.raises(ValueError):
        predict.train_and_score(frame(spark, bar("A", D(2024, 1, 1))), "2024-03-01", min_rows=2)

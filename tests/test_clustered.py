"""Clustering by interleaved bits, and how little of a table a chart reads."""

import datetime as dt

from pyspark.sql import functions as F

from candles.plans import jobs
from candles.sources import clustered

DAY0 = dt.date(2015, 1, 1)


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 1), (65535, 65535)], "a long, b long")
    got = [r[0] for r in df.select(clustered.interleaved(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 2, 1, 11, 2**32 - 1]


def test_a_symbols_year_reads_few_row_groups(spark, tmp_path):
    df = spark.range(100).select(F.format_string("S%03d", "id").alias("symbol")).crossJoin(
        spark.range(2000).select(F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("trade_date")))
    price = F.hash("symbol", "trade_date").cast("double")
    df = df.select("symbol", F.lit("1D").alias("interval"), "trade_date", *[price.alias(c) for c in ("open", "high", "low", "close")], F.lit(1).alias("volume"))
    path = f"{tmp_path}/t"
    clustered.write_clustered(df, path, group_bytes=16_000, file_rows=50_000)
    groups = clustered.row_groups(spark, path)
    assert sum(n for n, _ in groups) == 200_000 and len(groups) > 200

    def meets(values):
        return values["symbol"][0] <= "S042" <= values["symbol"][1] and values["trade_date"][0] <= "2017-12-31" and values["trade_date"][1] >= "2017-01-01"

    assert sum(meets(v) for _, v in groups) < 0.05 * len(groups)
    chart = jobs.candlestick(spark.read.parquet(path), "S042", end="2017-12-31")
    assert len(chart.collect()) == 365
    scan = chart._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < 0.06 * 200_000


def test_nulls_are_kept(spark, tmp_path):
    rows = [("A", DAY0, 1), (None, DAY0, 2), ("B", None, 3), (None, None, 4)]
    clustered.write_clustered(spark.createDataFrame(rows, "symbol string, trade_date date, v int"), f"{tmp_path}/t")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [1, 2, 3, 4]
    clustered.write_clustered(spark.createDataFrame([], "symbol string, trade_date date, v int"), f"{tmp_path}/none")
    assert spark.read.schema("v int").parquet(f"{tmp_path}/none").count() == 0

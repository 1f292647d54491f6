"""Market views over the star-schema tables: bars, ticks, listing and reports.

Prices are integer cents, so sums over them are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """One daily bar per supplier and ship date; trades are ordered by a full tie-break."""
    trade = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    price = cents("l_extendedprice")
    daily = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("trade_date"))
        .agg(
            F.min(trade)["l_extendedprice"].alias("first_price"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(trade)["l_extendedprice"].alias("last_price"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
            # An aggregate, not a literal: a constant would be folded out of the
            # partitioning keys and cost the series windows their shared shuffle.
            F.max(F.lit("1D")).alias("interval"),
        )
    )
    return daily.select(
        F.concat(F.lit("S"), F.col("l_suppkey")).alias("symbol"),
        "interval",
        "trade_date",
        cents("first_price").alias("open"),
        "high",
        "low",
        cents("last_price").alias("close"),
        "volume",
    )


def bars_mixed(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars and, as bars of their own, the weekly ones made of them."""
    daily = bars(spark, folder)
    week = F.date_add(F.date_trunc("week", "trade_date").cast("date"), 6)
    weekly = daily.groupBy("symbol", week.alias("trade_date")).agg(
        F.min_by("open", "trade_date").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "trade_date").alias("close"), F.sum("volume").alias("volume"),
        F.max(F.lit("1W")).alias("interval"))
    return daily.unionByName(weekly)


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    """One trade per event; the event type is the symbol."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("symbol"),
        "ts",
        "event_id",
        cents("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )


def listing(spark: SparkSession, folder: str) -> DataFrame:
    nation = F.col("s_nationkey") % 3
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("symbol"),
        F.when(nation == 0, "HOSE").when(nation == 1, "HNX").otherwise("UPCOM").alias("exchange"),
        F.col("s_name").alias("company_name"),
    )


def reports(spark: SparkSession, folder: str) -> DataFrame:
    kind, parity = F.col("o_orderkey") % 3, F.col("o_orderkey") % 2
    return table(spark, folder, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey")).alias("symbol"),
        F.when(kind == 0, "BalanceSheet")
        .when(kind == 1, "IncomeStatement")
        .otherwise("CashFlow")
        .alias("report_type"),
        F.when(parity == 0, "year").otherwise("quarter").alias("period"),
        F.col("o_orderdate").cast("date").alias("period_end"),
        F.col("o_orderkey").alias("report_id"),
        cents("o_totalprice").alias("amount"),
    )

"""Tables clustered by symbol and date, of which a chart reads few row groups.

A row's place is the interleaving of the bits of its symbol's rank and of its date's rank, so every stretch of
the table is a small rectangle of symbols and dates, and a row group's least and greatest symbol and date
say much, whether a reader asks for one symbol, for a year, or for both. Symbols also have Bloom filters,
which Parquet leaves out where a row group's dictionary tells the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BITS = 16
#: Bytes of a row group before compression, and rows of a file, about.
GROUP_BYTES, FILE_ROWS = 8 << 20, 5_000_000


def interleaved(one: Column, two: Column, bits: int = BITS) -> Column:
    """The bits of two whole numbers in turn, those of the first one ahead."""
    parts = []
    for k in range(bits):
        for number, shift in ((one, 2 * k + 1), (two, 2 * k)):
            parts.append(F.shiftleft(F.shiftright(number, k).bitwiseAND(F.lit(1)).cast("long"), shift))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """(column, name): the distinct values, spread in order over 0 to 2**BITS - 1. One row per symbol or
    per day, so that one task can number them."""
    values = df.select(column).distinct()
    place = F.percent_rank().over(Window.orderBy(column))
    return values.select(F.col(column).alias(f"_{column}"), F.floor(place * ((1 << BITS) - 1)).alias(name))


def write_clustered(
    df: DataFrame, path: str, by: tuple[str, str] = ("symbol", "trade_date"), group_bytes: int = GROUP_BYTES,
    file_rows: int = FILE_ROWS, mode: str = "error",
) -> None:
    """Write `df` in the order of both columns' interleaved ranks; nulls have the lowest rank."""
    placed = df
    for column, name in zip(by, ("_one", "_two")):
        placed = placed.join(_ranked(df, column, name), F.col(column).eqNullSafe(F.col(f"_{column}"))).drop(f"_{column}")
    placed = placed.withColumn("_place", interleaved(F.col("_one"), F.col("_two"))).drop("_one", "_two")
    files = max(1, -(-df.count() // file_rows))
    ordered = placed.repartitionByRange(files, "_place", *by).sortWithinPartitions("_place", *by).drop("_place")
    writer = ordered.write.mode(mode).option("parquet.block.size", group_bytes).option("parquet.page.size", min(group_bytes // 8, 1 << 20))
    writer.option(f"parquet.bloom.filter.enabled#{by[0]}", "true").parquet(path)


def row_groups(spark: SparkSession, path: str) -> list[list]:
    """Of each row group of a table, from the footers: rows, and per column (least, greatest) value."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    found = []
    for status in folder.getFileSystem(conf).listStatus(folder):
        if not status.getPath().getName().endswith(".parquet"):
            continue
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
            jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromStatus(status, conf))
        for block in reader.getFooter().getBlocks():
            columns = {c.getPath().toDotString(): c for c in block.getColumns()}
            found.append([block.getRowCount(), {
                n: (c.getStatistics().minAsString(), c.getStatistics().maxAsString()) for n, c in columns.items()}])
        reader.close()
    return found

"""Reading events, tables and files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candles import schemas


def kafka_options(servers: str, topic: str, starting: str = "earliest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def read_events(spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """Bounded read of raw events; `fmt` is "kafka", or "text" for files with one event a line."""
    return spark.read.format(fmt).options(**options).load(path)


def read_stream(
    spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Unbounded read of raw events. Bound a batch with `maxOffsetsPerTrigger` or its like."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_bars(spark: SparkSession, path: str, schema: T.StructType = schemas.BARS) -> DataFrame:
    """Landed bars under their fixed schema: an inferred one reads the folder `interval=1D` as 1.0."""
    return spark.read.schema(schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """CSV with a header, a byte order mark allowed; None when the path does not exist."""
    try:
        return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def file_info(spark: SparkSession, path: str, ext: str = "", recursive: bool = False) -> DataFrame:
    """Folder, name, size in KB and modification time per file; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{ext}")
        .option("recursiveFileLookup", recursive)
        .load(path)
    )
    parts = F.split("path", "/")
    return files.select(
        F.element_at(parts, -2).alias("folder"),
        F.element_at(parts, -1).alias("filename"),
        F.round(F.col("length") / 1024, 2).alias("size_kb"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("modified"),
    )


def list_files(spark: SparkSession, path: str, ext: str = ".csv") -> DataFrame:
    return file_info(spark, path, ext).select("filename").orderBy("filename")


def folder_summary(spark: SparkSession, path: str, ext: str = "") -> DataFrame:
    """File count and total size per folder."""
    return file_info(spark, path, ext, recursive=True).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.round(F.sum("size_kb"), 2).alias("size_kb")
    )


def run_ended(spark: SparkSession, path: str) -> bool:
    """Whether the last write to a table was completed: Spark leaves a marker beside its files."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def partition_values(df: DataFrame, columns: list[str]) -> list:
    """Distinct partition values: names of folders, as many as the table's layout has at most."""
    return df.select(*columns).distinct().collect()


def any_of(rows: list, columns: list[str]) -> Column:
    """Predicate for the given partition values, which the scan turns into partition filters."""
    *outer, inner = columns
    groups: dict[tuple, list] = {}
    for row in rows:
        groups.setdefault(tuple(row[c] for c in outer), []).append(row[inner])
    chosen = F.lit(False)
    for values, inners in groups.items():
        same = F.col(inner).isin([v for v in inners if v is not None])
        if None in inners:
            same = same | F.col(inner).isNull()
        for c, v in zip(outer, values):
            same = same & F.col(c).eqNullSafe(F.lit(v))
        chosen = chosen | same
    return chosen

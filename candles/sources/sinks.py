"""Writing tables: partitioned Parquet, keyed upsert, micro-batch append, CSV and metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candles.operators.incremental import replace_latest, staying_keys, uncovered, with_keys
from candles.operators.quality import counted, dedup_latest
from candles.session import discard, scratch
from candles.sources.readers import any_of, partition_values

# Monthly folders keep files large; one folder per symbol and day would not.
BAR_PARTITIONS = ["interval", "month"]
INDEX_PARTITIONS = ["month"]
#: Keys of an upsert that are sent to all tasks; more are dealt out.
SENT_KEYS = 100_000


def write_bars(
    df: DataFrame,
    path: str,
    partition_cols: list[str] = BAR_PARTITIONS,
    mode: str = "append",
    sort_cols: list[str] | None = None,
) -> None:
    """Partitioned Parquet. `mode` may be "replace": overwrite only the partitions in `df`.

    The rebalance hint gives each folder few files and lets adaptive execution split the
    folder that holds most of the rows. Sorting by symbol makes file statistics selective.
    """
    order = [*partition_cols, *(sort_cols or [c for c in ("symbol", "index_code", "trade_date") if c in df.columns])]
    out = df.hint("rebalance", *[F.col(c) for c in partition_cols]).sortWithinPartitions(*dict.fromkeys(order))
    writer = out.write.partitionBy(*partition_cols)
    if mode == "replace":
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet table at `path`, None if there is none yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def upsert(
    df: DataFrame,
    path: str,
    key: list[str],
    order: list[str] = (),
    partition_cols: list[str] = BAR_PARTITIONS,
    stored_rows: bool = False,
) -> None:
    """Insert or replace whole rows by key in a partitioned Parquet table.

    A row replaces the stored one unless it is older by `order`. Without `order` there is no telling
    which of two rows is newer, so a key that repeats within `df` is refused. Partition columns must
    be functions of the key, and `df` must have all stored columns; columns it has besides are NULL
    in the rows stored before. Only the folders that `df` touches are read and rewritten; their names
    are few, so they always make a predicate. The incoming rows are first written to scratch, unless
    `stored_rows` says that they come from a written copy; that is removed when the table is complete, so a lost
    executor does not recompute the feed. Folders are replaced when all of their new rows are written, so
    the plan may read them until then. Rerunning is harmless. Rows of a sealed month are refused, and
    nothing is written.
    """
    spark = df.sparkSession
    known = read_table(spark, path)
    missing = [c for c in known.columns if c not in df.columns] if known is not None else []
    if missing:
        raise ValueError(f"the table has columns that the rows lack: {missing}")
    arrived, stays = None if stored_rows else scratch(spark, "arrived"), None
    if arrived:
        df.write.parquet(arrived)
    incoming = spark.read.schema(df.schema).parquet(arrived) if arrived else df
    try:
        if not order and not incoming.groupBy(*key).count().filter("count > 1").isEmpty():
            raise ValueError("a key repeats, and nothing tells which row is newer")
        if known is None:
            write_bars(dedup_latest(incoming, key, list(order)) if order else incoming, path, partition_cols)
            return
        values = partition_values(incoming, partition_cols)
        closed = sealed(spark, path) & {v["month"] for v in values} if "month" in partition_cols else None
        if closed:
            raise ValueError(f"these months are sealed: {sorted(closed)}")
        touched = any_of(values, partition_cols)
        stored = read_table(spark, path, df.schema).filter(touched).select(*incoming.columns)
        if order:
            # The newest row of a key is found among stored and incoming rows at once.
            newest = replace_latest(stored, incoming, key, list(order))
        else:
            stays = scratch(spark, "staying")
            newest = _staying(stored, incoming, key, partition_cols, stays).unionByName(incoming)
        write_bars(newest, path, partition_cols, mode="replace")
    finally:
        discard(spark, *[p for p in (arrived, stays) if p])


def _staying(stored: DataFrame, incoming: DataFrame, key: list[str], partition_cols: list[str], path: str) -> DataFrame:
    """Stored rows whose key does not come in, one of each key. They are found by keys alone: rows that are replaced
    are not shuffled, and no row is if few keys stay or few come in."""
    keys = staying_keys(stored, incoming, key, partition_cols)
    keys.write.parquet(path)
    keys = stored.sparkSession.read.schema(keys.schema).parquet(path)
    repeated = not keys.filter("_stored > 1").isEmpty()
    if not repeated:
        stored = stored.filter(any_of(partition_values(keys, partition_cols), partition_cols))
    staying, coming = keys.count(), incoming.count()
    side, how = (keys, "left_semi") if staying < coming else (incoming, "left_anti")
    few = min(staying, coming) <= SENT_KEYS
    rows = with_keys(stored, F.broadcast(side.select(*key)) if few else side.select(*key).hint("merge"), key, how)
    return dedup_latest(rows, key, []) if repeated else rows


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append a micro-batch under its own folder; replaying the batch overwrites just that."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str, key: list[str], after: int = -1) -> DataFrame:
    """Rows of the micro-batches after number `after`; per key the row of the newest batch.

    To fold batches into a table, `upsert` this with the number of the last one folded.
    """
    df = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("bigint"))
    return dedup_latest(df.filter(F.col("batch") > after), key, ["batch"]).drop("batch")


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the micro-batches below `path`, by the names of their folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))


def fold_batches(spark: SparkSession, path: str, table: str, key: list[str], partition_cols: list[str] = BAR_PARTITIONS) -> int:
    """Move the micro-batches below `path` into a keyed table; returns how many.

    The newest batch stays, since a restarted stream may write it again. The others' folders are removed
    when the table is complete, so a run that fails is repeated without harm.
    """
    numbers = batch_numbers(spark, path)[:-1]
    if numbers:
        rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in numbers])
        rows = rows.withColumn("batch", F.col("batch").cast("bigint"))
        upsert(dedup_latest(rows, key, ["batch"]).drop("batch"), table, key, partition_cols=partition_cols)
        discard(spark, *[f"{path}/batch={n}" for n in numbers])
    return len(numbers)


def evict_batches(spark: SparkSession, path: str, covered: DataFrame, key: tuple[str, ...] = ("symbol", "interval"), day: str = "trade_date") -> int:
    """Remove the micro-batches, but for the newest, of which the batch view covers every row; returns
    how many."""
    numbers = batch_numbers(spark, path)[:-1]
    if not numbers:
        return 0
    rows = spark.read.option("basePath", path).parquet(*[f"{path}/batch={n}" for n in numbers])
    open_ = {int(r.batch) for r in uncovered(rows, covered, key, day).select("batch").distinct().collect()}
    gone = [n for n in numbers if n not in open_]
    discard(spark, *[f"{path}/batch={n}" for n in gone])
    return len(gone)


def seal(spark: SparkSession, path: str, months: list[str]) -> None:
    """Make months of a table read-only for `upsert`; a sealed month stays sealed."""
    for month in months:
        marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_sealed/{month}")
        marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def sealed(spark: SparkSession, path: str) -> set[str]:
    """Months that are read-only."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_sealed")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()


def write_csv(df: DataFrame | None, path: str) -> bool:
    """CSV with a header; False, and nothing left, if there are no rows. Rows are counted as they are written."""
    if df is None:
        return False
    rows, seen = counted(df, "csv")
    rows.write.mode("overwrite").option("header", True).csv(path)
    if seen.get["n"]:
        return True
    discard(df.sparkSession, path)
    return False


def write_many(frames: dict[str, DataFrame | None], path: str) -> dict[str, bool]:
    """Write several named frames below `path`; whether each had rows."""
    return {name: write_csv(df, f"{path}/{name}") for name, df in frames.items()}


def write_to(df: DataFrame, fmt: str, options: dict[str, str], mode: str = "append") -> None:
    """Any other sink a connector provides, such as "kafka" or a document store."""
    df.write.format(fmt).options(**options).mode(mode).save()


def metrics_frame(spark: SparkSession, metrics: list[tuple[str, str, float]]) -> DataFrame:
    return spark.createDataFrame(metrics, "model string, metric string, value double")

"""Compaction by file size: small files of a folder are put together up to a target, large ones stay.

Files are packed first-fit, longest first. The new files are complete in scratch, with as many rows as
the old ones, before a journal is written into the table that names both; then new files are moved in and old ones
removed. If that is interrupted, the next run ends it from the journal. Until it is ended a reader may see rows twice.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from candles.session import scratch, scratch_removed

TARGET_BYTES, SMALL = 128 << 20, 0.75
JOURNAL = "_compaction"


def file_sizes(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    """Bytes of each data file by folder; names and lengths only are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    found: dict[str, dict[str, int]] = defaultdict(dict)
    for r in files.select("_metadata.file_path", "_metadata.file_size").collect():
        folder, _, name = r.file_path.rpartition("/")
        found[folder][name] = r.file_size
    return dict(found)


def first_fit(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Names in bins of at most `target` bytes, longest first; a longer one has a bin of its own."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        for i, (filled, names) in enumerate(bins):
            if filled + size <= target:
                bins[i] = (filled + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins]


def plan(sizes: dict[str, dict[str, int]], target: int = TARGET_BYTES, small: float = SMALL) -> list[tuple[str, list[str]]]:
    """(folder, files to put together): bins of at least two files that are shorter than `small` targets."""
    return [
        (folder, names) for folder in sorted(sizes)
        for names in first_fit({n: s for n, s in sizes[folder].items() if s < small * target}, target) if len(names) > 1]


def pack(spark: SparkSession, path: str, sort_cols: list[str], target_bytes: int = TARGET_BYTES, small: float = SMALL) -> int:
    """Put small files of the Parquet table at `path` together; returns by how many files it has fewer."""
    recover(spark, path)
    bins = plan(file_sizes(spark, path), target_bytes, small)
    if not bins:
        return 0
    old = [f"{folder}/{name}" for folder, names in bins for name in names]
    named = spark.createDataFrame([(f"{folder}/{n}", i) for i, (folder, names) in enumerate(bins) for n in names], "_file string, _bin int")
    with scratch_removed(spark):
        # Columns that the folders' names hold stand in no file.
        rows = spark.read.option("basePath", path).parquet(*[unquote(f) for f in old])
        inner = [c for c in rows.columns if f"/{c}=" not in old[0]]
        rows = rows.select(*inner, F.col("_metadata.file_path").alias("_file"))
        staged = scratch(spark, "packed")
        packed = rows.join(named, "_file").drop("_file").repartition(len(bins), "_bin")
        packed.sortWithinPartitions("_bin", *[c for c in sort_cols if c in inner]).write.partitionBy("_bin").parquet(staged)
        if spark.read.parquet(staged).count() != rows.count():
            raise ValueError(f"{path} changed while it was packed")
        moves = []
        for folder, names in _staged(spark, staged).items():
            number = int(folder.rpartition("_bin=")[2])
            target = unquote(bins[number][0])
            moves += [[f"{folder}/{n}", f"{target}/packed-{uuid.uuid4().hex}.parquet"] for n in names]
        journal = f"{path}/{JOURNAL}/{uuid.uuid4().hex}.json"
        _write(spark, journal, json.dumps({"moves": moves, "old": [unquote(f) for f in old]}))
        recover(spark, path)
    return len(old) - len(moves)


def recover(spark: SparkSession, path: str) -> int:
    """End what journals say was begun; returns how many there were."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{JOURNAL}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
    for journal in found:
        todo = json.loads("\n".join(r.value for r in spark.read.text(str(journal.toString())).collect()))
        for source, final in todo["moves"]:
            source, final = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(final)
            if not fs.exists(final) and not fs.rename(source, final):
                raise OSError(f"cannot move {source}")
        for name in todo["old"]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(name), False)
        fs.delete(journal, False)
    return len(found)


def _staged(spark: SparkSession, path: str) -> dict[str, list[str]]:
    return {unquote(folder): sorted(files) for folder, files in file_sizes(spark, path).items()}


def _write(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    out.write(text.encode())
    out.close()


def file_count(sizes: dict[str, dict[str, int]]) -> int:
    return sum(len(files) for files in sizes.values())

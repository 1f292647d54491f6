"""Spark session defaults and the scratch folder used by jobs that must write."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# `interval=1D` would otherwise be read back as the double 1.0.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The files of a shuffle go with the action that made them, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app: str = "candles", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; `master` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local master may fall back to this machine's temporary folder: on a cluster a
    local path would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="candles-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch root."""
    path = os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
    made = _made.get()
    if made is not None:
        made.append(path)
    return path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders that are no longer needed."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Scratch folders of the block that this thread is in.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch folders made inside, once what reads them has been written.

    A block owns what its own thread makes in it, less what blocks inside it own; jobs in other threads
    keep theirs.
    """
    made: list[str] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        discard(spark, *made)


def apply_defaults(spark: SparkSession) -> None:
    """Put the defaults on a session that somebody else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)

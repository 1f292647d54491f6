"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candles.session import scratch

#: Rows of an Arrow batch. Long texts make wide rows, so batches are short.
BATCH_ROWS = 1000
#: Bytes of an Arrow batch; a longer row is a batch of its own.
BATCH_BYTES = 32 << 20


#: What this worker remembers.
_held: dict[tuple, object] = {}


def held_alone(make: Callable, *args):
    """The worker's `make(*args)`. A worker serves one stage after another and holds one of these at a time, so the
    memory of an earlier stage's operator is not added to that of a later one."""
    key = (make, *args)
    if key not in _held:
        _held.clear()
        _held[key] = make(*args)
    return _held[key]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def session_of(df: DataFrame) -> SparkSession:
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def dealt(df: DataFrame) -> DataFrame:
    """`df` as a side of a join that deals out both sides. Spark tells a table's size by its compressed files, and takes a
    function over rows to give as many as it gets, so a table that was packed well or made longer would seem small enough
    to be sent through the driver."""
    return df.hint("merge")


def stored(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """Write `df` to the shared folder, in folders by these columns, and read it back: it is computed
    once, and a lost executor costs no more than reading it again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, function: Callable[[dict], Iterable[dict]], schema: str) -> DataFrame:
    """mapInArrow with one dict of columns (Arrow arrays) in and any number of them out."""
    types = pa_schema(df.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for made in function(dict(zip(batch.schema.names, batch.columns))):
                    yield record(made, types)
        # Workers are kept for other tasks; what Arrow holds in reserve is given back.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [
        value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, type=field.type)
        for field in schema for value in [columns[field.name]]
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; a null counts as an empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")

"""Token ids of documents in ORC files.

Ids are stored as integer lists, which ORC run-length encodes; stripes have a fixed size so that a
file is read by several tasks, the row index and a Bloom filter on the document id let a lookup skip
stripes and row groups. Rows lie in ascending document order, over files as well as within one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candles.llm.common import arrow_map, pa_schema, record, session_of, text_bytes
from candles.llm.pieces import encoder

STRIPE_BYTES, INDEX_ROWS = 16 << 20, 1000


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
    mode: str = "error",
) -> None:
    """Encode every text, append `end_id`, and write (doc_id, row, before, n, ids) as ORC.

    Documents are dealt to files by range of the key and sorted in them (a null key first, equal
    keys by text). `row` is the row's place in its file, `before` the ids before it there, `n` its
    number of ids, so that summing a file does not read ids. A null text is empty and has the end id alone; no documents give an empty table.
    """
    spark = session_of(docs)
    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, row long, before long, n long, ids array<int>"
    types = pa_schema(spark, schema)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row, before = encoder(tokenizer).encode, 0, 0
        for batch in batches:
            flat, counts = encode(text_bytes(batch.column("text")))
            ends = np.cumsum(counts)
            ids = np.insert(flat.astype(np.int32), ends, end_id)
            edges = np.append(0, ends + np.arange(1, len(counts) + 1))
            yield record({
                "doc_id": batch.column("doc_id"), "row": np.arange(row, row + len(counts)),
                "before": before + edges[:-1], "n": np.diff(edges),
                "ids": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids)).cast(types.field("ids").type),
            }, types)
            row, before = row + len(counts), before + len(ids)

    rows.mapInArrow(run, schema).write.mode(mode).option("compression", "zstd").option(
        "orc.stripe.size", STRIPE_BYTES).option("orc.create.index", "true").option(
        "orc.row.index.stride", INDEX_ROWS).option("orc.bloom.filter.columns", "doc_id").orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): `start` counts the ids of all documents before this one.

    The running sum of the files' ids, in document order, is what a file starts from. That table has
    one row a file, whatever the documents, and is sent to the readers.
    """
    rows = spark.read.orc(path).withColumn("file", F.col("_metadata.file_path"))
    files = rows.groupBy("file").agg(
        F.sum("n").alias("all"), F.min_by("doc_id", "row").alias("first"),
        F.max("doc_id").alias("last"))
    order = Window.orderBy(F.col("first").asc_nulls_first(), F.col("last").asc_nulls_first(), "file")
    files = files.select("file", F.coalesce(F.sum("all").over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(files), "file").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "ids")


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of what `read_tokens` returns; the checksum is over the
    ids as little-endian unsigned 32-bit integers."""
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(columns: dict) -> Iterable[dict]:
        ids = columns["ids"]
        edges = ids.offsets.to_numpy()
        data = memoryview(ids.values.to_numpy().astype("<u4")).cast("B")
        yield {
            "doc_id": columns["doc_id"], "start": columns["start"], "n_tokens": np.diff(edges).astype(np.int64),
            "ids_crc32": [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(edges[:-1], edges[1:])],
        }

    return arrow_map(tokens, run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")

"""BPE encoding and decoding through a table of distinct words.

Texts are dealt into blocks. A block's texts are split into pieces (words with their blank, marks,
line feeds) and its distinct pieces go to the task that owns their hash, where a piece that many
blocks send is encoded once; the ids go back to the blocks that asked, and are put in place by
position. Decoding joins ids with the pieces of the vocabulary, which has a fixed size, once for
each distinct word, and strings the decoded words together by position.

Only distinct words of a block are shuffled and not every occurrence, and they travel packed: one
row for each block and owner. Blocks hold about `BLOCK_BYTES` of text, so neither a task's memory nor
the number of words it sends grows with the input.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candles.llm.common import pa_schema, record, session_of
from candles.llm.pieces import Encoder, encoder, gather, sections

BLOCK_BYTES, HELD_BYTES, ROWS = 8 << 20, 12 << 20, 256
#: Bytes whose pieces are told apart at once.
SECTION_BYTES = 2 << 20
BLOCKS, WORDS = "block int, body binary", "block int, owner int, body binary"


def packed(arrays: list[pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def unpacked(body: bytes) -> list[pa.Array]:
    data = zstandard.ZstdDecompressor().decompress(body)
    return pa.ipc.open_stream(data).read_next_batch().columns


@lru_cache(maxsize=2)
def vocabulary(path: str) -> list[bytes]:
    """Bytes of each id's piece. A byte-level vocabulary writes a byte as one visible character:
    those of Latin-1 that can be seen as themselves, the others from U+0100 on in order."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    byte_of = {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}
    pieces = encoder(path).tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(pieces.values(), default=-1) + 1)
    for piece, number in pieces.items():
        out[number] = bytes(map(byte_of.get, piece)) if all(c in byte_of for c in piece) else piece.encode()
    return out


def byte_level(path: str) -> bool:
    with open(path, encoding="utf-8") as file:
        return (json.load(file).get("decoder") or {}).get("type") == "ByteLevel"


def _words(encode: Encoder, texts: list[bytes]) -> tuple[dict[bytes, int], list[int], list[np.ndarray], list[int]]:
    """Distinct pieces of a block numbered, the hash of each, and by section the numbers in place;
    last, the text that each part of a section belongs to, with its pieces."""
    number: dict[bytes, int] = {}
    hashes: list[int] = []
    placed, owners = [], []
    for texts_of, parts in sections(texts, SECTION_BYTES):
        codes, words, hashed, per = encode.split(parts)
        known = len(number)
        own = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words))
        fresh = own >= known
        hashes.extend(hashed[fresh].tolist())
        placed.append(own[codes])
        owners.append((np.array(texts_of), per))
    return number, hashes, placed, owners


def _by_owner(number: dict[bytes, int], hashes: list[int], owners: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(owner, its words, their numbers) in an order that only the words decide."""
    words, hashed = list(number), np.array(hashes, np.uint64)
    owner = (hashed % np.uint64(owners)).astype(np.int64)
    order = np.lexsort([hashed, owner])
    if (np.diff(hashed[order]) == 0).any():
        order = np.array(sorted(range(len(words)), key=lambda i: (owner[i], hashes[i], words[i])))
    bounds = np.searchsorted(owner[order], np.arange(owners + 1))
    for at in np.flatnonzero(np.diff(bounds)):
        own = order[bounds[at]:bounds[at + 1]]
        yield int(at), [words[i] for i in own], own


def _blocks(docs: DataFrame, key: str, text: str, owners: int) -> DataFrame:
    """The texts by block, packed: (block, body)."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(owners, -(-size // BLOCK_BYTES))
    rows = rows.select("id", F.col("text").cast("binary").alias("text"),
                       F.pmod(F.xxhash64("id", "text"), F.lit(count)).cast("int").alias("block"))
    types = pa_schema(docs.sparkSession, BLOCKS)

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pa.Table.from_batches(held).combine_chunks().to_batches():
            blocks = batch.column("block").to_numpy()
            order = np.argsort(blocks, kind="stable")
            bounds = np.flatnonzero(np.diff(blocks[order], prepend=-1))
            made = [batch.take(pa.array(o)) for o in np.split(order, bounds[1:])]
            for part in made:
                yield record({"block": [part.column("block")[0].as_py()],
                              "body": [packed([part.column("id"), part.column("text")])]}, types)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > HELD_BYTES:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return rows.mapInArrow(run, BLOCKS)


def transcode(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", packed_ids: bool = False,
) -> DataFrame:
    """(key, ids array<int>, decoded string) per row of `docs`; with `packed_ids` ids are one binary
    value of little-endian unsigned 32-bit integers.

    ids are what the tokenizer gives for the whole text without special tokens added, decoded is
    what it makes of them with special tokens kept. A null text counts as empty: no ids, an empty
    text. Repeated rows come back as often as they came in; no rows give no rows.
    """
    if not byte_level(tokenizer):
        raise ValueError("only byte-level tokenizers are decoded by pieces")
    spark = session_of(docs)
    owners = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.select(key).schema[0].dataType.simpleString()
    out = f"id {kind}, ids {'binary' if packed_ids else 'array<int>'}, decoded string"
    blocks = _blocks(docs, key, text, owners)
    sent, types = pa_schema(spark, WORDS), pa_schema(spark, out)

    def texts_of(table: pa.Table) -> tuple[pa.Array, list[bytes]]:
        parts = [unpacked(b) for b in table.column("body").to_pylist()]
        return pa.concat_arrays([p[0] for p in parts]), [t for p in parts for t in p[1].to_pylist()]

    def ask(table: pa.Table) -> pa.Table:
        number, hashes, _, _ = _words(encoder(tokenizer), texts_of(table)[1])
        block = table.column("block")[0].as_py()
        made = [(at, packed([pa.array(w, pa.binary())])) for at, w, _ in _by_owner(number, hashes, owners)]
        return pa.Table.from_batches([record({
            "block": [block] * len(made), "owner": [a for a, _ in made], "body": [b for _, b in made]}, sent)])

    def answer(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        encode.forget()
        for batch in batches:
            for block, owner, body in zip(*(c.to_pylist() for c in batch.columns)):
                number = encode.lookup(unpacked(body)[0].to_pylist())
                flat, counts = gather(encode.ids, encode.begins[number], encode.counts[number])
                body = packed([pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(flat))])
                yield record({"block": [block], "owner": [owner], "body": [body]}, sent)
        encode.forget()

    def place(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return types.empty_table()
        ids, bodies = texts_of(texts)
        number, hashes, placed, parts = _words(encoder(tokenizer), bodies)
        replies = dict(zip(answers.column("owner").to_pylist(), answers.column("body").to_pylist()))
        counts, begins = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        flats, size = [], 0
        for at, _, own in _by_owner(number, hashes, owners):
            lists = unpacked(replies[at])[0]
            edges = lists.offsets.to_numpy().astype(np.int64)
            counts[own], begins[own] = np.diff(edges), size + edges[:-1]
            flats.append(lists.values.to_numpy())
            size += int(edges[-1])
        flat = np.concatenate(flats) if flats else np.zeros(0, np.uint32)
        pieces = vocabulary(tokenizer)
        bounds = zip(begins.tolist(), (begins + counts).tolist())
        decoded = [b"".join(map(pieces.__getitem__, flat[a:e].tolist())) for a, e in bounds]
        total, made, texts_out = np.zeros(len(bodies), np.int64), [], [b""] * len(bodies)
        for own, (texts_in, per) in zip(placed, parts):
            run, each = gather(flat, begins[own], counts[own])
            ends, edges = np.append(0, np.cumsum(each)), np.append(0, np.cumsum(per))
            np.add.at(total, texts_in, ends[edges[1:]] - ends[edges[:-1]])
            made.append(run)
            words = list(map(decoded.__getitem__, own.tolist()))
            for n, a, e in zip(texts_in.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
                texts_out[n] += b"".join(words[a:e])
        values = np.concatenate(made).astype(np.uint32, copy=False) if made else np.zeros(0, np.uint32)
        edges = np.append(0, np.cumsum(total))
        if packed_ids:
            data = memoryview(values.astype("<u4", copy=False)).cast("B")
            lists = pa.array([bytes(data[4 * a:4 * e]) for a, e in zip(edges[:-1].tolist(), edges[1:].tolist())], pa.binary())
        else:
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values.view(np.int32)))
        strings = pa.array([t.decode("utf-8", "replace") for t in texts_out], pa.string())
        made = pa.Table.from_arrays([ids.cast(types.field("id").type), lists.cast(types.field("ids").type), strings], schema=types)
        return pa.Table.from_batches(made.to_batches(max_chunksize=ROWS))

    words = blocks.groupBy("block").applyInArrow(ask, WORDS)
    replies = words.repartition("owner").mapInArrow(answer, WORDS)
    made = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(place, out)
    return made.withColumnRenamed("id", key)


def digests(made: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of what `transcode` returns with packed ids."""
    return made.select(
        key, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

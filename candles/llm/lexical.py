"""Ranked lexical search over posting lists that are blocked by document similarity.

Documents are taken into shards of bounded size. A shard puts its documents into an order of
similarity (a tree of halves: a part is cut at the median along the direction between two documents
far from each other), and every term's posting list is cut into blocks along that order, so that a
block holds documents alike. A block's summary is the largest impact of each term in any of its
documents, unrounded and for every term that a query asks for together with the list's own. The product of a summary and
a query's weights bounds the score of each document of the block; a block is skipped only if that bound is below the
score of the kth document known so far. All others are scored in full, so results are exact.

An impact depends on the text and the corpus alone, a weight on the corpus alone. Only terms of queries
have posting lists. A sixteenth of the shards is searched first; the kth scores found there are sent to
all others, which skip from the beginning. Queries are taken in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, pa_schema, record, session_of, stored, text_bytes

K = 50
#: Queries and bytes of their texts in a block of queries.
QUERIES, QUERY_BYTES = 256, 128 << 10
#: Documents of a shard, numbers in a shard's table of documents and terms, documents of a block.
SHARD, CELLS, BLOCK = 2048, 8 << 20, 64
#: One of so many shards is searched before the others; blocks scored between two looks at the cutoff.
FIRST, AT_ONCE = 16, 16

#: Bytes of terms as themselves, A-Z in lower case, all others blank.
_TERMS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: bytes) -> list[bytes]:
    """Maximal strings of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TERMS).split()


class Queries:
    """A block of queries: their terms, numbered, and for each term those asked for together with it."""

    def __init__(self, ids: list, texts: list[bytes]):
        found = [sorted(set(terms_of(t))) for t in texts]
        self.ids = ids
        self.code = {term: i for i, term in enumerate(sorted({t for f in found for t in f}))}
        self.terms = [np.array([self.code[t] for t in f], np.int64) for f in found]
        beside: list[set[int]] = [set() for _ in self.code]
        for own in self.terms:
            for term in own.tolist():
                beside[term].update(own.tolist())
        self.beside = [np.array(sorted(b), np.int64) for b in beside]
        self.weights = np.zeros(len(self.code), np.int64)

    def weigh(self, documents: int, having: dict[int, int]) -> None:
        for term in range(len(self.code)):
            self.weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * having.get(term, 0) + 1)))

    @property
    def shard(self) -> int:
        """Documents of a shard, so that its table has at most `CELLS` numbers."""
        return max(BLOCK, min(SHARD, CELLS // max(len(self.code), 1)))


def similarity_order(points: np.ndarray, leaf: int = BLOCK) -> np.ndarray:
    """Rows in an order that keeps those in like directions together."""
    norms = np.linalg.norm(points, axis=1, keepdims=True)
    points = points / np.where(norms > 0, norms, 1)
    parts, whole = [np.arange(len(points))], []
    while parts:
        own = parts.pop()
        if len(own) <= leaf:
            whole.append(own)
            continue
        some = points[own]
        one = some[int(np.argmin(some @ some[0]))]
        two = some[int(np.argmin(some @ one))]
        order = np.argsort(some @ (two - one), kind="stable")
        half = len(own) // 2
        parts += [own[order[half:]], own[order[:half]]]
    return np.concatenate(whole) if whole else np.zeros(0, np.int64)


class Shard:
    """Posting lists of some documents. `terms` are those present; lists stand one after another: `rows`
    (documents), `impacts`, list j from ends[j - 1] to ends[j]; `summaries` likewise."""

    def __init__(self, ids: list, terms, ends, rows, impacts, summaries, queries: Queries):
        self.ids, self.queries = ids, queries
        self.terms, self.ends, self.rows, self.impacts, self.summaries = terms, ends, rows, impacts, summaries
        self.begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.table = np.zeros((len(ids), len(terms)), np.int32)
        self.table[rows, np.repeat(np.arange(len(terms)), ends - self.begins)] = impacts
        column = np.full(len(queries.code), -1, np.int64)
        column[terms] = np.arange(len(terms))
        self.column = column

    def beside(self, j: int) -> np.ndarray:
        """Columns of a list's summaries."""
        columns = self.column[self.queries.beside[self.terms[j]]]
        return columns[columns >= 0]

    @classmethod
    def build(cls, ids: list, lengths: list[int], codes: list, counts: list, n: int, total: int, queries: Queries) -> Shard:
        of = np.repeat(np.arange(len(ids)), [len(c) for c in codes])
        codes, counts = np.concatenate(codes).astype(np.int64), np.concatenate(counts).astype(np.int64)
        m = np.array([50 + 50 * length * n // total for length in lengths], np.int64)
        impacts = 1_000_000_000 * counts // (1000 * counts + 20 * m[of])
        terms, column = np.unique(codes, return_inverse=True)
        points = np.zeros((len(ids), len(terms)), np.float32)
        points[of, column] = impacts * queries.weights[codes]
        order = similarity_order(points)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by = np.lexsort((place[of], column))
        ends = np.cumsum(np.bincount(column, minlength=len(terms)))
        made = cls([ids[i] for i in order.tolist()], terms, ends, place[of][by], impacts[by], None, queries)
        parts = [np.zeros(0, np.int32)]
        for j, (begin, end) in enumerate(zip(made.begins.tolist(), ends.tolist())):
            own = made.table[np.ix_(made.rows[begin:end], made.beside(j))]
            parts.append(np.maximum.reduceat(own, np.arange(0, end - begin, BLOCK), axis=0).ravel())
        made.summaries = np.concatenate(parts)
        return made

    def lists(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(list, its columns, its summaries as a table of blocks)."""
        at = 0
        for j, size in enumerate((self.ends - self.begins).tolist()):
            columns = self.beside(j)
            blocks = -(-size // BLOCK)
            yield j, columns, self.summaries[at:at + blocks * len(columns)].reshape(blocks, len(columns))
            at += blocks * len(columns)

    def search(self, k: int, cutoffs: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, int]]:
        """(query, documents, scores, blocks scored, blocks) for each query with documents here: all
        documents whose score is above 0, at least the query's cutoff and at least the kth best here.
        An impact is below 1e6 and a weight below 1e5, so doubles hold the scores of queries of up to 9e4
        terms exactly; longer ones are taken in 64-bit integers."""
        lists = {j: (columns, table) for j, columns, table in self.lists()}
        for q, terms in enumerate(self.queries.terms):
            own = self.column[terms]
            own = own[own >= 0]
            if not len(own):
                continue
            exact = np.float64 if len(own) < 90_000 else np.int64
            weights = self.queries.weights[self.terms[own]].astype(exact)
            bounds, whose, where = [], [], []
            for j in own.tolist():
                columns, table = lists[j]
                bound = table[:, np.searchsorted(columns, own)].astype(exact) @ weights
                bounds.append(bound)
                whose.append(np.full(len(bound), j))
                where.append(np.arange(len(bound)))
            bounds, whose, where = (np.concatenate(x) for x in (bounds, whose, where))
            order = np.argsort(-bounds, kind="stable")
            cutoff, at, step = max(1, int(cutoffs[q])), 0, AT_ONCE
            known, scores = np.zeros(len(self.ids), bool), np.zeros(len(self.ids), np.int64)
            while at < len(order) and bounds[order[at]] >= cutoff:
                some = order[at:at + step]
                some = some[bounds[some] >= cutoff]
                at, step = at + len(some), 2 * step
                rows = [self.rows[self.begins[j] + BLOCK * b:min(self.ends[j], self.begins[j] + BLOCK * (b + 1))]
                        for j, b in zip(whose[some].tolist(), where[some].tolist())]
                rows = np.unique(np.concatenate(rows))
                rows = rows[~known[rows]]
                known[rows] = True
                scores[rows] = self.table[np.ix_(rows, own)].astype(exact) @ weights
                best = scores[known]
                if len(best) > k:
                    cutoff = max(cutoff, int(np.partition(best, len(best) - k)[len(best) - k]))
            rows = np.flatnonzero(known & (scores >= cutoff))
            yield q, rows, scores[rows], at, len(order)


def _packed(shard: Shard) -> dict:
    return {"ids": [shard.ids], **{c: [getattr(shard, c).astype(np.int32).tobytes()] for c in _ARRAYS}}


_ARRAYS = ("terms", "ends", "rows", "impacts", "summaries")


def _forward(docs: DataFrame, sent) -> DataFrame:
    """(id, n, codes, counts) of documents with terms: how many, and which of the queries' how often."""

    def run(columns: dict) -> Iterable[dict]:
        code = sent.value.code
        made: dict[str, list] = {"n": [], "codes": [], "counts": []}
        for text in text_bytes(columns["text"]):
            words = terms_of(text)
            own = np.fromiter(map(code.get, words, repeat(-1)), np.int32, len(words))
            own, counts = np.unique(own[own >= 0], return_counts=True)
            made["n"].append(len(words))
            made["codes"].append(own.tobytes())
            made["counts"].append(counts.astype(np.int32).tobytes())
        yield {"id": columns["id"], **made}

    kind = docs.schema["id"].dataType.simpleString()
    return arrow_map(docs, run, f"id {kind}, n long, codes binary, counts binary").where(F.col("n") > 0)


def _having(forward: DataFrame) -> dict[int, int]:
    """Documents that hold each term."""
    types = pa_schema(forward.sparkSession, "term int, df long")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.int32)
            one = np.bincount(codes, minlength=len(total))
            one[:len(total)] += total
            total = one
        held = np.flatnonzero(total)
        yield record({"term": held, "df": total[held]}, types)

    rows = forward.select("codes").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r.term: r.df for r in rows.collect()}


def _index(forward: DataFrame, sent, n: int, total: int) -> DataFrame:
    """One row per shard, in folders by whether it is searched first."""
    kind = forward.schema["id"].dataType.simpleString()
    out = f"shard long, ids array<{kind}>, " + ", ".join(f"{c} binary" for c in _ARRAYS)
    types = pa_schema(forward.sparkSession, out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal number
            ids, lengths, codes, counts = zip(*held)
            arrays = ([np.frombuffer(x, np.int32) for x in part] for part in (codes, counts))
            made = _packed(Shard.build(list(ids), list(lengths), *arrays, n, total, queries))
            number += 1
            held.clear()
            return record({"shard": [number], **made}, types)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "codes", "counts"))):
                held.append(row)
                if len(held) == queries.shard:
                    yield flush()
        if held:
            yield flush()

    rows = forward.where(F.octet_length("codes") > 0).mapInArrow(run, out)
    return stored(rows.withColumn("first", F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0), "lexical-index", "first")


def _found(index: DataFrame, sent, k: int, item_kind: str, cutoffs=None) -> DataFrame:
    """(query, item, id, score): each shard's best."""
    kind = index.schema["ids"].dataType.elementType.simpleString()

    def run(columns: dict) -> Iterable[dict]:
        queries = sent.value
        least = cutoffs.value if cutoffs else np.zeros(len(queries.ids), np.int64)
        for i in range(len(columns["ids"])):
            arrays = (np.frombuffer(columns[c][i].as_buffer(), np.int32) for c in _ARRAYS)
            shard = Shard(columns["ids"][i].as_py(), *arrays, queries)
            for q, rows, scores, _, _ in shard.search(k, least):
                best = [(-s, shard.ids[r] is None, shard.ids[r] if shard.ids[r] is not None else 0)
                        for r, s in zip(rows.tolist(), scores.tolist())]
                best = sorted(best)[:k]
                yield {"query": [q] * len(best), "item": [queries.ids[q]] * len(best),
                       "id": [None if none else x for _, none, x in best], "score": [-s for s, _, _ in best]}

    return arrow_map(index.select("ids", *_ARRAYS), run, f"query int, item {item_kind}, id {kind}, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _answered(docs: DataFrame, rows: list, k: int, item_kind: str) -> DataFrame:
    """(item, rank, id, score) for one block of queries."""
    context = docs.sparkSession.sparkContext
    queries = Queries([r.id for r in rows], [(r.text or "").encode() for r in rows])
    forward = stored(_forward(docs, context.broadcast(queries)), "lexical-forward")
    size = forward.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total")).first()
    queries.weigh(size.n, _having(forward))
    sent = context.broadcast(queries)
    index = _index(forward, sent, size.n, size.total or 1)
    first = stored(_found(index.where("first"), sent, k, item_kind), "lexical-first")
    cutoffs = np.zeros(len(queries.ids), np.int64)
    for r in _ranked(first, k).where(F.col("rank") == k).collect():
        cutoffs[r.query] = r.score
    rest = _found(index.where("not first"), sent, k, item_kind, context.broadcast(cutoffs))
    return stored(_ranked(first.union(rest), k).select("item", "rank", "id", "score"), "lexical-best")


def search(
    docs: DataFrame, queries: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", k: int = K,
) -> DataFrame:
    """(item_key, rank, key, score): the k documents with the highest scores above 0 for each query.

    The score is in whole numbers; `Queries.weigh` and `Shard.build` hold its formula. Equal scores go to the smaller
    key, null keys last. Null texts and texts without terms match nothing and do not count. Repeated
    rows are documents, or queries, of their own. Very long texts are taken whole. Other columns are not
    looked at; `key` and `item_key` must differ from each other and from rank and score.
    """
    spark = session_of(docs)
    kind, item_kind = (d.select(c).schema[0].dataType.simpleString() for d, c in ((docs, key), (queries, item_key)))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null")
    asked = queries.select(F.col(item_key).alias("id"), F.col(item_text).alias("text")).where("text is not null")
    asked = stored(asked.withColumn("node", F.monotonically_increasing_id()), "lexical-queries")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size.n // QUERIES), -(-(size.bytes or 0) // QUERY_BYTES))
    found = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == block).orderBy("node").collect()
        if own:
            found.append(_answered(rows, own, k, item_kind))
    if not found:
        return spark.createDataFrame([], f"{item_key} {item_kind}, rank int, {key} {kind}, score long")
    best = reduce(DataFrame.union, found)
    return best.select(F.col("item").alias(item_key), "rank", F.col("id").alias(key), "score")

"""Exact search for the k highest inner products by a three-phase uniform threshold.

Vectors become whole numbers and are stored by columns: their components are cut into lists, and a list
knows the part of each vector that it holds, hence a local score; a score is the sum over all lists.

1. Every list gives the highest local scores of each query. What was gathered is scored in full; the
   kth best of these scores is a safe cutoff.
2. The cutoff is sent out. Every list returns the entries whose local score is at least the cutoff's
   share, cutoff / lists: a vector below that share in all lists is below the cutoff. Entries of a
   vector are added up. Where lists are missing, each can add less than its share, which bounds the
   score from above; what stays below the cutoff is dropped.
3. The complete scores raise the cutoff. What can still reach it asks the missing lists for their
   local scores, and the k best of all complete scores are the answer.

Queries are taken in blocks of bounded size, and each block is compared with all vectors. Entries of
a vector meet per block of vectors, so a group is bounded by a block of queries times a block of
vectors, whatever the scores. Of equal vectors the k + 1 with the smallest keys are candidates: no
other can be among the k best.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, pa_schema, record, session_of, stored
from candles.llm.embeddings import matrix

K, SCALE, LISTS = 5, 256, 2
#: Highest local scores that each list gives of a query, as a multiple of k.
DEPTH = 4
#: Queries and bytes of a block of queries.
QUERIES, QUERY_BYTES = 2048, 4 << 20
_NONE = np.iinfo(np.int64).min


def product(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: as doubles where all partial sums are, else in 64 bits."""
    one, two = (np.abs(x.astype(np.float64)).max(initial=0) for x in (vectors, queries))
    most = one * two * max(vectors.shape[1], 1)
    if most < 2**53:
        return (vectors.astype(np.float64) @ queries.T.astype(np.float64)).astype(np.int64)
    if most >= 2**60:
        raise ValueError("inner products of these vectors exceed 64 bits")
    return vectors @ queries.T


def columns_of(dimension: int, lists: int) -> list[slice]:
    """The components of each list."""
    cuts = np.linspace(0, dimension, max(1, min(lists, dimension)) + 1).astype(int).tolist()
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


class Block:
    """A block of queries, by dimension: number of the first, their nodes and their vectors."""

    def __init__(self, rows: list, lists: int):
        rows = sorted(rows, key=lambda r: (len(r.v), r.node))
        self.nodes = np.array([r.node for r in rows], np.int64)
        self.lists = lists
        self.of: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(r.v) for r in rows], np.int64)
        for d in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == d)
            self.of[d] = int(at[0]), self.nodes[at], np.array([rows[i].v for i in at], np.int64).reshape(len(at), d)

    def local(self, d: int, number: int, nodes: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Local scores of all queries in one list, (vectors, queries); a query's own row has none."""
        _, own, queries = self.of[d]
        scores = product(part, queries[:, columns_of(d, self.lists)[number]])
        spot = np.minimum(np.searchsorted(own, nodes), len(own) - 1)
        mine = np.flatnonzero(own[spot] == nodes)
        scores[mine, spot[mine]] = _NONE
        return scores


def _opened(columns: dict, queries: Block) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, int]]:
    """(dimension, list, block, nodes, part, row) of the stored lists that queries need."""
    for i, (d, number, block) in enumerate(zip(*(columns[c].to_pylist() for c in ("d", "list", "block")))):
        if d in queries.of:
            nodes = np.frombuffer(columns["nodes"][i].as_buffer(), np.int64)
            yield d, number, block, nodes, np.frombuffer(columns["part"][i].as_buffer(), np.int64).reshape(len(nodes), -1), i


def _stored_lists(vectors: DataFrame, lists: int) -> DataFrame:
    """(d, list, block, nodes, part): blocks of vectors of one dimension, one row per list. A block has
    the node of its first vector as number."""

    def cut(columns: dict) -> Iterable[dict]:
        lengths = np.diff(columns["v"].offsets.to_numpy())
        for d in np.unique(lengths).tolist():
            own = pa.array(np.flatnonzero(lengths == d))
            nodes = columns["node"].take(own).to_numpy()
            found = matrix(columns["v"].take(own)).astype(np.int64).reshape(len(nodes), d)
            parts = columns_of(d, lists)
            yield {
                "d": [d] * len(parts), "list": list(range(len(parts))), "block": [int(nodes[0])] * len(parts),
                "nodes": [nodes.tobytes()] * len(parts), "part": [np.ascontiguousarray(found[:, p]).tobytes() for p in parts]}

    made = arrow_map(vectors.select("node", "v"), cut, "d int, list int, block long, nodes binary, part binary")
    return stored(made, "topk-lists")


def _gathered(stored_lists: DataFrame, sent, depth: int) -> DataFrame:
    """(q, block, place): the `depth` highest local scores of each query in each list."""
    out = "q int, list int, local long, block long, place int"
    types = pa_schema(stored_lists.sparkSession, out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], list[np.ndarray]] = {}
        queries = sent.value
        for batch in batches:
            for d, number, block, nodes, part, _ in _opened(dict(zip(batch.schema.names, batch.columns)), queries):
                scores = queries.local(d, number, nodes, part).T
                where = np.broadcast_to(np.arange(len(nodes)), scores.shape)
                whose = np.full(scores.shape, block)
                if (d, number) in best:
                    scores, whose, where = (np.hstack(x) for x in zip(best[d, number], (scores, whose, where)))
                if scores.shape[1] > depth:
                    kept = np.argpartition(~scores, depth - 1, axis=1)[:, :depth]
                    scores, whose, where = (np.take_along_axis(x, kept, 1) for x in (scores, whose, where))
                best[d, number] = [scores, whose, where]
        for (d, number), (scores, whose, where) in best.items():
            q = np.repeat(np.arange(len(scores)) + queries.of[d][0], scores.shape[1])
            real = scores.ravel() != _NONE
            yield record({"q": q[real], "list": np.full(int(real.sum()), number), "local": scores.ravel()[real],
                          "block": whose.ravel()[real], "place": where.ravel()[real]}, types)

    first = Window.partitionBy("q", "list").orderBy(F.desc("local"), "block", "place")
    found = stored_lists.mapInArrow(run, out).withColumn("nth", F.row_number().over(first))
    return found.where(F.col("nth") <= depth).select("q", "block", "place").distinct()


def _asked(requests: DataFrame, stored_lists: DataFrame, sent, cutoffs=None) -> DataFrame:
    """(q, node, score) of the requests (block, q, place, known, missing), packed arrays of a block: what
    is known of a score plus the local scores of the missing lists (bits). Requests that cannot reach
    `cutoffs` are left out."""

    def run(columns: dict) -> Iterable[dict]:
        queries = sent.value
        made: dict[str, list] = {"q": [], "node": [], "score": []}
        for d, number, _, nodes, part, i in _opened(columns, queries):
            q, place, known, missing = _unpacked(columns, i)
            need = missing >> number & 1 == 1
            if cutoffs is not None:
                gaps = sum(missing >> g & 1 for g in range(len(columns_of(d, queries.lists))))
                need &= known + gaps * (_share(cutoffs.value[0][q], d, queries.lists) - 1) >= cutoffs.value[1][q]
            q, place = q[need], place[need]
            base, _, matrix_ = queries.of[d]
            lanes = columns_of(d, queries.lists)[number]
            # What is known is added by the first of the missing lists.
            first = missing[need] & ((1 << number) - 1) == 0
            made["q"].append(q)
            made["node"].append(nodes[place])
            made["score"].append(_pairwise(part, place, matrix_[:, lanes], q - base) + np.where(first, known[need], 0))
        yield {c: np.concatenate(x) if x else np.zeros(0, np.int64) for c, x in made.items()}

    rows = stored_lists.join(requests, "block")
    return arrow_map(rows, run, "q int, node long, score long").groupBy("q", "node").agg(F.sum("score").alias("score"))


def _pairwise(part: np.ndarray, place: np.ndarray, queries: np.ndarray, q: np.ndarray, at_once: int = 1 << 16) -> np.ndarray:
    """Inner products of part[place] and queries[q], row by row."""
    most = np.abs(part.astype(np.float64)).max(initial=0) * np.abs(queries.astype(np.float64)).max(initial=0)
    if most * max(part.shape[1], 1) >= 2**60:
        raise ValueError("inner products of these vectors exceed 64 bits")
    out = np.zeros(len(q), np.int64)
    for i in range(0, len(q), at_once):
        s = slice(i, i + at_once)
        out[s] = np.einsum("nd,nd->n", part[place[s]], queries[q[s]])
    return out


def _unpacked(columns: dict, i: int) -> tuple[np.ndarray, ...]:
    return tuple(np.frombuffer(columns[c][i].as_buffer(), np.int64) for c in ("q", "place", "known", "missing"))


def _share(cutoff: np.ndarray, d: int, lists: int) -> np.ndarray:
    """The least local score worth sending: below it in all lists is below the cutoff."""
    return -(-cutoff // len(columns_of(d, lists)))


def _sufficient(stored_lists: DataFrame, sent, cutoffs, k: int) -> DataFrame:
    """(block, nodes, scores, best, q, place, known, missing) per block of vectors: its best complete
    scores (query numbers, nodes, scores) and the requests still open."""

    def entries(columns: dict) -> Iterable[dict]:
        queries = sent.value
        for d, number, block, nodes, part, _ in _opened(columns, queries):
            base, own, _ = queries.of[d]
            scores = queries.local(d, number, nodes, part)
            cutoff = cutoffs.value[0][base:base + len(own)]
            share = np.where(cutoff == _NONE, _NONE + 1, _share(cutoff, d, queries.lists))
            at = np.flatnonzero((scores >= share).ravel())
            yield {"block": [block], "d": [d], "list": [number], "nodes": [nodes.tobytes()], "at": [at.tobytes()],
                   "local": [scores.ravel()[at].tobytes()]}

    packed = "known binary, missing binary"
    out = f"block long, best_q binary, best_node binary, best_score binary, q binary, place binary, {packed}"
    types = pa_schema(stored_lists.sparkSession, out)

    def added(rows: pa.Table) -> pa.Table:
        queries, d = sent.value, rows["d"][0].as_py()
        base, own, _ = queries.of[d]
        every = (1 << len(columns_of(d, queries.lists))) - 1
        at = [np.frombuffer(x, np.int64) for x in rows["at"].to_pylist()]
        local = np.concatenate([np.frombuffer(x, np.int64) for x in rows["local"].to_pylist()])
        bits = np.repeat(1 << np.array(rows["list"].to_pylist(), np.int64), [len(x) for x in at])
        at = np.concatenate(at)
        order = np.argsort(at, kind="stable")
        at, local, bits = at[order], local[order], bits[order]
        begin = np.flatnonzero(np.diff(at, prepend=-1))
        known, seen = (np.add.reduceat(x, begin) if len(begin) else x for x in (local, bits))
        at = at[begin]
        q, place = at % len(own) + base, at // len(own)
        nodes = np.frombuffer(rows["nodes"][0].as_buffer(), np.int64)
        full = seen == every
        order = np.lexsort((nodes[place[full]], -known[full], q[full]))
        ranked_q, ranked = q[full][order], np.flatnonzero(full)[order]
        nth = np.arange(len(ranked)) - np.searchsorted(ranked_q, ranked_q)
        best = ranked[nth < k]
        missing = every & ~seen
        gaps = sum(missing >> g & 1 for g in range(every.bit_length()))
        cutoff = cutoffs.value[0][q]
        still = ~full & (known + gaps * (_share(cutoff, d, queries.lists) - 1) >= cutoff)
        return pa.Table.from_batches([record({
            "block": [rows["block"][0].as_py()], "best_q": [q[best].tobytes()], "best_node": [nodes[place[best]].tobytes()],
            "best_score": [known[best].tobytes()], "q": [q[still].tobytes()], "place": [place[still].tobytes()],
            "known": [known[still].tobytes()], "missing": [missing[still].tobytes()]}, types)])

    sent_entries = arrow_map(stored_lists, entries, "block long, d int, list int, nodes binary, at binary, local binary")
    return stored(sent_entries.groupBy("block").applyInArrow(added, out), "topk-entries")


def _complete(found: DataFrame) -> DataFrame:
    """(q, node, score) of the complete scores of `_sufficient`."""

    def run(columns: dict) -> Iterable[dict]:
        for i in range(len(columns["best_q"])):
            yield {c: np.frombuffer(columns[f"best_{c}"][i].as_buffer(), np.int64) for c in ("q", "node", "score")}

    return arrow_map(found.select("best_q", "best_node", "best_score"), run, "q int, node long, score long")


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _cutoffs(scores: DataFrame, k: int, queries: int) -> np.ndarray:
    """The kth best score of each query of a block; the least number where there are fewer."""
    out = np.full(queries, _NONE)
    for r in _best(scores, k).where(F.col("rank") == k).collect():
        out[r.q] = r.score
    return out


def _answered(stored_lists: DataFrame, rows: list, k: int, lists: int, depth: int) -> DataFrame:
    """(query, node, score, rank) for one block of queries."""
    context = stored_lists.sparkSession.sparkContext
    queries = Block(rows, lists)
    sent = context.broadcast(queries)

    def packed(columns: dict) -> Iterable[dict]:
        # Requests of the first phase know nothing yet and miss every list.
        n = [len(x) for x in columns["asked"].to_pylist()]
        flat = columns["asked"].flatten()
        cut = np.cumsum(n)[:-1]
        of = {c: np.split(flat.field(c).to_numpy().astype(np.int64), cut) for c in ("q", "place")}
        yield {"block": columns["block"], **{c: [x.tobytes() for x in of[c]] for c in of},
               "known": [bytes(8 * x) for x in n], "missing": [np.full(x, (1 << lists) - 1).tobytes() for x in n]}

    asked = _gathered(stored_lists, sent, depth).groupBy("block").agg(F.collect_list(F.struct("q", "place")).alias("asked"))
    requests = arrow_map(asked, packed, "block long, q binary, place binary, known binary, missing binary")
    first = stored(_asked(requests, stored_lists, sent), "topk-first")
    low = _cutoffs(first, k, len(queries.nodes))
    entries = _sufficient(stored_lists, sent, context.broadcast((low,)), k)
    complete = stored(first.union(_complete(entries)).distinct(), "topk-complete")
    high = np.maximum(low, _cutoffs(complete, k, len(queries.nodes)))
    open_ = entries.select("block", "q", "place", "known", "missing")
    rest = _asked(open_, stored_lists, sent, context.broadcast((low, high)))
    best = _best(complete.union(rest).distinct(), k)
    nodes = context.broadcast(queries.nodes)

    def named(columns: dict) -> Iterable[dict]:
        yield {"query": nodes.value[columns["q"].to_numpy()], **{c: columns[c] for c in ("node", "score", "rank")}}

    return stored(arrow_map(best, named, "query long, node long, score long, rank int"), "topk-best")


def search(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: float = SCALE,
    lists: int = LISTS,
) -> DataFrame:
    """(query_id, rank, <key>, score): of each row that `is_query` (a condition on the key) holds for, the
    k other rows with the highest inner products of floor(scale * component).

    Equal scores go to the smaller key, null keys last. Null vectors and those with null or non-finite
    components take no part; vectors of different lengths do not meet, and those without components
    score 0 with each other. Repeated rows are rows of their own, only a query's own row is left out; a
    query without any other row has no result. Other columns are not looked at. Scores beyond 2**60
    raise an error. The work is that of comparing every query with every vector.
    """
    spark = session_of(vectors)
    kind = vectors.select(key).schema[0].dataType.simpleString()
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(
        F.col(key).alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & finite).withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("long")))
    # Nodes are numbered in the order of the keys, so that ties go by node.
    good = stored(rows.orderBy(F.col("id").asc_nulls_last()).withColumn("node", F.monotonically_increasing_id()), "topk-rows")
    same = Window.partitionBy("v").orderBy("node")
    candidates = good.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= k + 1)
    kept = _stored_lists(candidates, lists)
    size = good.where("asks").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v")).alias("numbers")).first()
    blocks = max(-(-size.n // QUERIES), -(-8 * (size.numbers or 0) // QUERY_BYTES))
    asking = good.where("asks").select("node", "v", F.pmod(F.xxhash64("node"), F.lit(max(blocks, 1))).alias("part"))
    asking = stored(asking, "topk-queries", "part")
    found = []
    for block in range(blocks):
        own = asking.where(F.col("part") == block).select("node", "v").collect()
        if own:
            found.append(_answered(kept, own, k, lists, DEPTH * k))
    if not found:
        return spark.createDataFrame([], f"query_id {kind}, rank int, {key} {kind}, score long")
    best = reduce(DataFrame.union, found)
    ids = good.select("node", "id")
    best = best.join(ids, "node").withColumnRenamed("id", "near").drop("node")
    best = best.join(ids.withColumnRenamed("node", "query"), "query")
    return best.select(F.col("id").alias("query_id"), "rank", F.col("near").alias(key), "score")

"""Near-duplicates by SimHash anchors and the exact Jaccard similarity of word shingles.

Links are texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8. SimHash
anchors (`simhash.links`) bring texts together whose fingerprints differ in at most 2 bits; these are
verified by their shingles, and their components are what the rest starts from. Texts as similar as
0.8 can differ in 11 bits, so anchors alone lose links, and a prefix filter finds the others. All
shingles are put into one order, rare ones first. If two sets of a and b shingles are that similar,
they share one among the first a/5 + 1 and b/5 + 1 of them, so texts are only
compared if they share a shingle there; none is lost. Shingles of one text alone come first, and
never leave the task that finds them so.

Links are wanted for their components only. Of the texts that anchors leave apart, each text of a shingle is at first
compared with the next one by length, with some in a random order that differs from shingle to shingle, and with the
shingle's first text: so many comparisons for each prefix row, which bring nearly all of a large family of
near copies into one component. Then only texts of a shingle that lie in different components
are compared. Before that, and before anything is verified, a bitmap is: each shingle flips one of 1,024
bits, so two sets differ in at least as many shingles as their bitmaps differ in bits. So a large
group of near copies is never expanded into its pairs, nor is one of texts just below 0.8.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candles.llm import simhash
from candles.llm.common import arrow_map, dealt, session_of, stored, text_bytes
from candles.llm.components import components
from candles.llm.pieces import _WHITE, factorize
from candles.llm.quality import groups

WORDS = 5
#: Bits of a shingle's hash; the others of a 64-bit number hold a text's place in its batch.
BITS = 48
MASK = np.uint64((1 << BITS) - 1)
#: 64-bit words of a bitmap, and texts of a shingle that are put in order at once.
MAP_WORDS, SLICE = 16, 4096
#: Places in the random order of a shingle's texts whose texts a text is compared with at first.
PARTNERS = (1, 2, 4, 8)
#: Characters of text whose shingles are counted at once, which bounds a task's memory.
COUNTED_CHARS, LEAST_OWNERS = 16_000_000, 12
#: Odd multipliers of the shingle hash.
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def node_of(text: bytes) -> int:
    """64-bit number of a text's words: A-Z lower-cased, between ASCII white space."""
    return xxhash.xxh3_64_intdigest(b" ".join(text.lower().split()))


def shingles(texts: list[bytes]) -> np.ndarray:
    """Sorted place << 48 | hash of the distinct shingles of each text (at most 65,536 texts). A text
    of fewer than five words is one shingle, one without words has none."""
    buffer = b"\n".join(texts).lower() + b"\n"
    white = _WHITE[np.frombuffer(buffer, np.uint8)]
    first = np.flatnonzero(~white & np.append(True, white[:-1]))
    stop = np.flatnonzero(~white & np.append(white[1:], True)) + 1
    codes, words, _ = factorize(buffer, first, stop)
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)[codes]
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]) - 1, first)
    count = max(len(hashes) - WORDS + 1, 0)
    mixed = hashes[:count].copy()
    for k in range(1, WORDS):
        mixed = mixed * STEP + hashes[k:k + count]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * MIX
    mixed ^= mixed >> np.uint64(29)
    whole = owner[:count] == owner[WORDS - 1:]
    short = np.bincount(owner, minlength=len(texts))
    short = np.flatnonzero((short > 0) & (short < WORDS))
    alone = np.array([node_of(texts[i]) for i in short], np.uint64)
    places = np.concatenate([owner[:count][whole], short]).astype(np.uint64)
    tokens = np.concatenate([mixed[whole], alone]) >> np.uint64(64 - BITS)
    return np.unique(places << np.uint64(BITS) | tokens)


def sets_of(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, end, shingles) of ranges of the texts."""
    for begin, end in groups(texts):
        yield begin, end, shingles(texts[begin:end])


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """The bits that are set by an odd number of shingles."""
    flips = np.bincount((tokens % np.uint64(64 * MAP_WORDS)).astype(np.int64), minlength=64 * MAP_WORDS) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def _nodes(texts: list[bytes]) -> np.ndarray:
    return np.array([node_of(t) for t in texts], np.uint64).view(np.int64)


def anchored(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (a, b): nodes of texts that SimHash brings together. A fingerprint's texts are paired with its
    first one, and the first texts of fingerprints that meet at an anchor with each other."""

    def number(columns: dict) -> Iterable[dict]:
        texts = text_bytes(columns["text"])
        made = np.array([simhash.fingerprint(x) for x in texts], np.uint64)
        yield {"node": _nodes(texts), "fp": pa.array(made.view(np.int64))}

    numbered = arrow_map(docs.select(F.col(text).alias("text")), number, "node long, fp long")
    texts = stored(numbered.distinct(), "jaccard-fingerprints")
    leads = stored(texts.groupBy("fp").agg(F.min("node").alias("lead")), "jaccard-leads")
    equal = texts.join(leads, "fp").where("node != lead").select("node", "lead")
    near = simhash.links(leads)
    near = near.join(leads.select(F.col("fp").alias("a"), F.col("lead").alias("node")), "a")
    near = near.join(leads.select(F.col("fp").alias("b"), "lead"), "b").select("node", "lead")
    return equal.union(near).select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))


def shared_shingles(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, df, node, n) of every shingle that `df` >= 2 different texts have; n is the number
    of the text's shingles."""
    chars = docs.agg(F.sum(F.char_length(text))).first()[0] or 0
    owners = max(LEAST_OWNERS, 1 + chars // COUNTED_CHARS)

    def deal(columns: dict) -> Iterable[dict]:
        texts = text_bytes(columns["text"])
        for begin, end, packed in sets_of(texts):
            nodes = _nodes(texts[begin:end])
            places = (packed >> np.uint64(BITS)).astype(np.int64)
            sizes = np.bincount(places, minlength=end - begin)
            owner = ((packed & MASK) % np.uint64(owners)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
            out: dict[str, list] = {"owner": [], "nodes": [], "sizes": [], "counts": [], "tokens": []}
            for part in np.split(order, cuts[1:]) if len(order) else ():
                # Shingles come by place, so their numbers tell the places.
                used, counts = np.unique(places[part], return_counts=True)
                out["owner"].append(int(owner[part[0]]))
                out["nodes"].append(nodes[used].tobytes())
                out["sizes"].append(sizes[used].astype(np.int64).tobytes())
                out["counts"].append(counts.astype(np.int32).tobytes())
                out["tokens"].append(packed[part].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BITS // 8].tobytes())
            yield out

    def count(rows: pa.Table) -> pa.Table:
        tokens, nodes, sizes = [], [], []
        for n, s, c, t in zip(*(rows[c].to_pylist() for c in ("nodes", "sizes", "counts", "tokens"))):
            counts = np.frombuffer(c, np.int32)
            wide = np.zeros((counts.sum(), 8), np.uint8)
            wide[:, :BITS // 8] = np.frombuffer(t, np.uint8).reshape(-1, BITS // 8)
            tokens.append(wide.view("<i8").ravel())
            nodes.append(np.repeat(np.frombuffer(n, np.int64), counts))
            sizes.append(np.repeat(np.frombuffer(s, np.int64), counts))
        token, node, size = (np.concatenate(x) for x in (tokens, nodes, sizes))
        order = np.lexsort((node, token))
        token, node, size = token[order], node[order], size[order]
        # Copies of a text come with the same node and count once.
        new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
        token, node, size = token[new], node[new], size[new]
        begins = np.flatnonzero(np.diff(token, prepend=-1))
        df = np.diff(np.append(begins, len(token)))
        df = np.repeat(df, df)
        return pa.table({"token": token[df > 1], "df": df[df > 1], "node": node[df > 1], "n": size[df > 1]})

    dealt = arrow_map(docs.select(F.col(text).alias("text")), deal, "owner int, nodes binary, sizes binary, counts binary, tokens binary")
    return dealt.groupBy("owner").applyInArrow(count, "token long, df long, node long, n long")


def prefixes(shared: DataFrame) -> DataFrame:
    """(token, df, node, n, pos) of the shingles of a text's prefix that other texts have; pos is its place
    in the text's order, rare shingles first."""
    of = Window.partitionBy("node")
    nth = F.row_number().over(of.orderBy("df", "token"))
    placed = shared.select("token", "df", "node", "n", (F.col("n") - F.count(F.lit(1)).over(of) + nth - 1).alias("pos"))
    return placed.where(F.col("pos") <= F.floor(F.col("n") / 5))


def _possible(a: str, b: str) -> Column:
    """Whether as many shingles as 0.8 needs can be shared if the first shared one is at these places, and
    the bitmaps do not differ in more than a ninth of both sets' shingles."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = reduce(add, (F.bit_count(F.col(f"{a}.bits.b{k}").bitwiseXOR(F.col(f"{b}.bits.b{k}"))) for k in range(MAP_WORDS)))
    return (F.least(n - F.col(f"{a}.pos"), m - F.col(f"{b}.pos")) * 9 >= (n + m) * 4) & (differ * 9 <= n + m)


def _pairs(found: DataFrame) -> DataFrame:
    """Distinct (a, b) of rows with structs x and y that anchors leave apart."""
    rows = found.where((F.col("x.root") != F.col("y.root")) & _possible("x", "y"))
    return rows.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of at least 0.8."""

    def run(columns: dict) -> Iterable[dict]:
        near = []
        for x, y in zip(columns["x"].to_pylist(), columns["y"].to_pylist()):
            one, two = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            near.append(9 * len(np.intersect1d(one, two, assume_unique=True)) >= 4 * (len(one) + len(two)))
        kept = pa.array(near, pa.bool_())
        yield {"a": columns["a"].filter(kept), "b": columns["b"].filter(kept)}

    rows = pairs.join(dealt(sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))), "a")
    rows = rows.join(dealt(sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))), "b")
    return arrow_map(rows.select("a", "b", "x", "y"), run, "a long, b long")


def _candidate_sets(docs: DataFrame, nodes: DataFrame, text: str) -> DataFrame:
    """(node, tokens, bits) of the texts with these nodes: their sorted shingles, and the bitmap of them."""

    def number(columns: dict) -> Iterable[dict]:
        yield {"node": _nodes(text_bytes(columns["text"])), "text": columns["text"]}

    def cut(columns: dict) -> Iterable[dict]:
        texts = text_bytes(columns["text"])
        for begin, end, packed in sets_of(texts):
            parts = np.split(packed & MASK, np.searchsorted(packed >> np.uint64(BITS), np.arange(1, end - begin)))
            maps = np.stack([bitmap(p) for p in parts])
            yield {"node": columns["node"].slice(begin, end - begin), "tokens": [p.tobytes() for p in parts],
                   "bits": pa.StructArray.from_arrays(list(maps.T.copy()), [f"b{k}" for k in range(MAP_WORDS)])}

    named = arrow_map(docs.select(F.col(text).alias("text")), number, "node long, text string")
    texts = named.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))
    bits = ", ".join(f"b{k}: long" for k in range(MAP_WORDS))
    return arrow_map(texts, cut, f"node long, tokens binary, bits struct<{bits}>")


def _hung(roots: DataFrame) -> DataFrame:
    """Components (node, root) as links (a, b)."""
    return roots.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def links(docs: DataFrame, text: str = "text") -> DataFrame:
    """(a, b): links between the nodes of texts; their components are those of all pairs that are
    similar enough."""
    first, _, across = _linked(docs, text)
    return first.union(across)


def _linked(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The links of texts that are near in an order, the components (node, root) of these links, and the
    links between them."""
    pairs = stored(anchored(docs, text), "jaccard-anchored")
    kept = stored(prefixes(shared_shingles(docs, text)), "jaccard-prefixes")
    many = kept.groupBy("token").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    kept = kept.join(dealt(many.select("token")), "token", "left_semi")
    sets = stored(_candidate_sets(docs, kept.select("node").distinct(), text), "jaccard-sets")
    # Texts without a set share no shingle with a text that is similar enough.
    near = stored(_verified(pairs, sets), "jaccard-near")
    anchors = components(near, "jaccard-anchors")
    placed = kept.join(dealt(sets.select("node", "bits")), "node").join(anchors, "node", "left")
    me = F.struct("node", "n", "pos", "bits", F.coalesce("root", "node").alias("root"))
    kept = stored(placed.select("token", "df", "node", me.alias("x")), "jaccard-placed")
    # A shingle's texts are put in order in slices, and every slice knows the shingle's first text.
    slices = F.pmod(F.xxhash64("node"), F.ceil(F.col("df") / SLICE))
    cut = kept.select("token", "x", slices.alias("slice"), F.xxhash64("node", "token").alias("mixed"))
    of = Window.partitionBy("token", "slice")
    mixed = of.orderBy("mixed", "x.node")
    others = F.array(F.lag("x").over(of.orderBy("x.n", "x.node")), *[F.lag("x", k).over(mixed) for k in PARTNERS])
    beside = cut.withColumn("y", others).select("x", F.explode("y").alias("y")).where("y is not null")
    firsts = kept.groupBy("token").agg(F.min_by("x", F.struct("x.n", "x.node")).alias("y"))
    nearby = stored(_pairs(beside.union(kept.join(dealt(firsts), "token").select("x", "y"))), "jaccard-nearby")
    more = stored(_verified(nearby, sets), "jaccard-links")
    # Components that are known go on as links of their nodes to their roots.
    roots = components(_hung(anchors).union(more), "jaccard-first")
    # What is in one component needs no more links; all else that shares a shingle is compared.
    told = stored(kept.join(roots, "node", "left").select("token", "x", F.coalesce("root", "node").alias("root")), "jaccard-told")
    mixed = told.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    open_ = told.join(dealt(mixed.select("token")), "token", "left_semi")
    other = open_.select("token", F.col("root").alias("other"), F.col("x").alias("y"))
    across = open_.join(dealt(other), "token").where((F.col("root") < F.col("other")) & _possible("x", "y"))
    across = _pairs(across).join(nearby.union(pairs), ["a", "b"], "left_anti")
    return near.union(more), roots, stored(_verified(across, sets), "jaccard-across")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, component_id) per row of `docs`: component_id is the smallest key reachable over pairs
    with a similarity of at least 0.8. Null and empty texts are copies of each other, repeated rows come back
    as often as they came in, other columns are not looked at. The shingles of a very long text are held by the task that
    cuts it and, as one row, by those that verify its pairs."""
    session_of(docs)

    def number(columns: dict) -> Iterable[dict]:
        yield {"id": columns["id"], "node": _nodes(text_bytes(columns["text"]))}

    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    nodes = stored(arrow_map(rows, number, f"id {kind}, node long"), "jaccard-nodes")
    _, known, across = _linked(docs, text)
    roots = components(_hung(known).union(across), "jaccard-components")
    distinct = nodes.groupBy("node").agg(F.min("id").alias("first"))
    grouped = stored(distinct.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root")), "jaccard-roots")
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    of = grouped.join(least, "root").select("node", "component_id")
    return nodes.join(of, "node").select(F.col("id").cast(kind).alias(key), "component_id")

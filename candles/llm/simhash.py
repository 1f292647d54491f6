"""SimHash near-duplicates by anchor points of a covering code.

Links are fingerprints that differ in at most `THRESHOLD` = 2 of 64 bits. The anchors are the code
words of two perfect binary Golay codes of length 23 laid side by side over the low 46 bits: every
23-bit word is within 3 bits of exactly one code word (the covering radius). A fingerprint has its
home at that pair of code words, and is replicated to every anchor within covering radius plus
threshold: a partner within 2 bits of a fingerprint is, in either half, at most 3 plus its share of
the 2 bits away from that fingerprint's home. These are 61 anchors on average of 2^24, whatever
the data. At an anchor, fingerprints at home there are compared with the replicas, so each pair is
seen once, at the home of its smaller fingerprint, and none is lost.

Equal fingerprints are one node, so copies are never expanded into pairs; a distinct fingerprint has
at most 2,080 partners. Crowded anchors are split by the skew join, which only repeats the rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, dealt, session_of, stored, text_bytes
from candles.llm.components import components

WORDS, SEED, THRESHOLD = 3, 42, 2
#: Shingles hashed at once, which bounds the memory that a very long text takes.
AT_ONCE = 1 << 16
#: Fixed value: the generator polynomial of the binary Golay code, x^11+x^9+x^7+x^6+x^5+x+1.
GOLAY, LENGTH, CHECKS, RADIUS = 0b101011100011, 23, 11, 3


def fingerprint(text: bytes) -> int:
    """64-bit SimHash of a text: A-Z lower-cased, words between ASCII white space, shingles of
    three words with repeats; fewer words are one shingle, none give 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - WORDS + 1, 1)
    width = min(WORDS, len(words))
    begins, stops = starts[:last].tolist(), ends[width - 1:width - 1 + last].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, last, AT_ONCE):
        cut = zip(begins[at:at + AT_ONCE], stops[at:at + AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cut], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp long) per row; a null text counts as empty."""
    session_of(docs)

    def run(columns: dict) -> Iterable[dict]:
        made = np.array([fingerprint(x) for x in text_bytes(columns["text"])], np.uint64)
        yield {"id": columns["id"], "fp": pa.array(made.view(np.int64))}

    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return arrow_map(rows, run, f"id {kind}, fp long")


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - CHECKS)), rest)
    return rest


@cache
def patterns() -> list[tuple[np.ndarray, np.ndarray]]:
    """For an excess of 0, 1 and 2 bits over the covering radius: the error patterns ordered by
    syndrome, and where each of the 2,048 syndromes begins."""
    out = []
    for weights in (range(RADIUS + 1), (RADIUS + 1,), (RADIUS + 2,)):
        chosen = np.array(sorted(sum(1 << bit for bit in bits) for k in weights for bits in combinations(range(LENGTH), k)), np.int64)
        syndrome = _syndrome(chosen)
        order = np.argsort(syndrome, kind="stable")
        begins = np.searchsorted(syndrome[order], np.arange((1 << CHECKS) + 1))
        out.append((chosen[order], begins))
    return out


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) of all anchors that the fingerprints of an array go to."""
    mask = (1 << LENGTH) - 1
    halves = [(fps >> np.uint64(s)).astype(np.int64) & mask for s in (0, LENGTH)]
    syndromes = [_syndrome(h) for h in halves]
    rows, anchors, homes = [], [], []
    for one in range(THRESHOLD + 1):
        for two in range(THRESHOLD + 1 - one):
            (first, at1), (second, at2) = patterns()[one], patterns()[two]
            n1 = at1[syndromes[0] + 1] - at1[syndromes[0]]
            n2 = at2[syndromes[1] + 1] - at2[syndromes[1]]
            row = np.repeat(np.arange(len(fps)), n1 * n2)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(n1 * n2) - n1 * n2, n1 * n2)
            low = halves[0][row] ^ first[at1[syndromes[0][row]] + nth // n2[row]]
            high = halves[1][row] ^ second[at2[syndromes[1][row]] + nth % n2[row]]
            rows.append(row)
            anchors.append(low | high << LENGTH)
            homes.append(np.full(len(row), one + two == 0))
    return np.concatenate(rows), np.concatenate(anchors), np.concatenate(homes)


def links(fps: DataFrame) -> DataFrame:
    """(a, b) for all pairs of distinct fingerprints (column fp) that differ in 1 or 2 bits."""

    def replicas(columns: dict) -> Iterable[dict]:
        values = columns["fp"].to_numpy(zero_copy_only=False)
        row, anchor, _ = anchors_of(values.view(np.uint64))
        yield {"anchor": anchor, "b": values[row]}

    def homes(columns: dict) -> Iterable[dict]:
        values = columns["fp"].to_numpy(zero_copy_only=False)
        bits = values.view(np.uint64)
        out, (first, _) = [], patterns()[0]
        for shift in (0, LENGTH):
            half = (bits >> np.uint64(shift)).astype(np.int64) & ((1 << LENGTH) - 1)
            out.append(half ^ first[_syndrome(half)])
        yield {"anchor": out[0] | out[1] << LENGTH, "a": values}

    home = arrow_map(fps.select("fp"), homes, "anchor long, a long")
    away = arrow_map(fps.select("fp"), replicas, "anchor long, b long")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= THRESHOLD
    return home.join(dealt(away), (home.anchor == away.anchor) & (F.col("a") < F.col("b")) & near).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint, component_id) per row of `docs`.

    component_id is the smallest key reachable over links, null only where all keys of a component
    are null. Null and empty texts have fingerprint 0 and link like any other; repeated rows come
    back as often as they came in; no rows give no rows.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()
    fps = stored(fingerprints(docs, key, text), "simhash")
    distinct = stored(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(links(distinct), "simhash-links")
    grouped = distinct.join(roots, distinct.fp == roots.node, "left")
    grouped = stored(grouped.select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    of = grouped.join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp").select(
        F.col("id").cast(kind).alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

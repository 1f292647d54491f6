"""Runs of repeated words, found by minimizers of several scales.

A run is a stretch of words with smallest period q that is at least `EXPONENT` periods long and cannot
be made longer. Periods of up to `DIRECT` words are found by comparing all words with those q places
on. For longer ones, scale k = 16, 32, 64, ... covers the periods above k/2 and up to k. A gram of k
words inside such a run comes again q places on and nowhere between, since a primitive period has no
equal rotations. Of every window of k/2 grams the least is kept (by a 64-bit hash); a window at the
start of a run and the one q places on both lie inside the run if it is four periods long, so they keep
the same gram, and two neighbouring equal minimizers are q apart. Such pairs are the seeds. Two equal
grams that overlap are a repetition already, so texts that do not repeat themselves have no seeds.
Seeds are extended over the words themselves, so every reported run is exact.

A task works on its own texts, whole, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, session_of, text_bytes
from candles.llm.quality import groups

#: Periods a run has at least (the proof above needs four), and its fewest words.
EXPONENT, LEAST = 4, 6
#: Longest period that is scanned directly; the first scale begins above it.
DIRECT = 8
RUNS = "array<struct<start: long, length: long, period: long>>"
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _B
    return values ^ (values >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """`best` of every `width` values on end; width is a power of two."""
    step = 1
    while step < width:
        values = best(values[:-step], values[step:])
        step *= 2
    return values


def _direct(words: np.ndarray, period: int) -> Iterable[tuple[int, int]]:
    """(start, length) of the stretches with this period that are long enough."""
    edges = np.flatnonzero(words[period:] != words[:-period])
    edges = np.concatenate([[-1], edges, [len(words) - period]])
    same = np.diff(edges) - 1
    for i in np.flatnonzero(same >= max(LEAST, EXPONENT * period) - period).tolist():
        yield int(edges[i]) + 1, int(same[i]) + period


def _seeds(grams: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, distances) of neighbouring equal minimizers, by distance, then place."""
    width = k // 2
    if len(grams) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = _sliding(grams, width, np.minimum)
    none = np.zeros(width - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([none, least, none]), width, np.maximum) == grams)
    order = at[np.argsort(grams[at], kind="stable")]
    far = np.diff(order)
    pair = np.flatnonzero((grams[order[1:]] == grams[order[:-1]]) & (far > width) & (far <= k))
    place, far = order[pair], far[pair]
    by = np.lexsort((place, far))
    return place[by], far[by]


def _same(words: np.ndarray, one: int, two: int, step: int) -> int:
    """How many words from places `one` < `two` on (step 1) or before them (step -1) are equal."""
    done, chunk = 0, 64
    while True:
        if step > 0:
            a, b = words[one + done:one + done + chunk], words[two + done:two + done + chunk]
            a = a[:len(b)]
        else:
            low = max(one - done - chunk, 0)
            a = words[low:one - done][::-1]
            b = words[low + two - one:two - done][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + int(differ[0])
        done += len(a)
        if len(a) < chunk:
            return done
        chunk *= 4


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no shorter period divides this one (the stretch is at least two periods long)."""
    one, left, prime = words[start:start + period], period, 2
    while left > 1:
        if prime * prime > left:
            prime = left
        if left % prime == 0:
            shift = period // prime
            if np.array_equal(one, words[start + shift:start + shift + period]):
                return False
            while left % prime == 0:
                left //= prime
        prime += 1
    return True


def runs(words: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in texts that stand one after another, each with a number of
    its own behind it. `lengths` are the texts' words and one more, the longest text first."""
    found = []
    for period in range(1, DIRECT + 1):
        found += [(s, n, period) for s, n in _direct(words, period)] if len(words) > period else []
    ends, k = np.cumsum(lengths), 1
    grams = _mixed(words.astype(np.uint64) * _A + _B)
    while True:
        # Texts that are too short for a scale stand at the end and are left out from there on.
        enough = int((lengths > EXPONENT * max(DIRECT, k) + EXPONENT).sum())
        if not enough:
            break
        grams = grams[:ends[enough - 1]]
        grams = _mixed(grams[:-k] * _A + (grams[k:] ^ (grams[k:] >> np.uint64(31))) * _B)
        k *= 2
        if k <= DIRECT:
            continue
        last, stop = 0, 0
        for place, period in zip(*(x.tolist() for x in _seeds(grams, k))):
            if period == last and place + period + k <= stop:
                continue
            before = _same(words, place, place + period, -1)
            start, last = place - before, period
            stop = place + period + _same(words, place, place + period, 1)
            if stop - start >= EXPONENT * period:
                found.append((start, stop - start, period))
    return [r for r in found if _primitive(words, r[0], r[2])]


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words, by start, then period."""
    numbers: dict[bytes, int] = {}
    fresh = count()
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    parts = [np.fromiter(map(numbers.setdefault, texts[i], fresh), np.int64, len(texts[i])) for i in order]
    lengths = np.array([len(p) + 1 for p in parts], np.int64)
    begins = np.cumsum(lengths) - lengths
    words = np.full(int(lengths.sum()), -1, np.int64)
    for begin, part in zip(begins.tolist(), parts):
        words[begin:begin + len(part)] = part
    words[begins + lengths - 1] = -1 - np.arange(len(parts))
    made: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in sorted(runs(words, lengths), key=lambda r: (r[0], r[2])):
        own = int(np.searchsorted(begins, start, side="right")) - 1
        made[order[own]].append((start - int(begins[own]), length, period))
    return made


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, runs, collapsed) per row of `docs`.

    Words are what stands between ASCII white space. `runs` lists every run's (start, length, period)
    in words, by start, then period. `collapsed` is the text, its words joined by one blank, without
    the words that stand in any run after its first period. A null, empty or blank text has no runs and
    an empty `collapsed`; repeated rows and null keys are rows of their own; other columns are not
    looked at. A very long text is taken whole: memory grows with the longest text of a task.
    """
    session_of(docs)
    kind = docs.select(key).schema[0].dataType.simpleString()

    def find(columns: dict) -> Iterable[dict]:
        texts = text_bytes(columns["text"])
        for begin, end in groups(texts):
            words = [t.split() for t in texts[begin:end]]
            found = runs_of_texts(words)
            collapsed = []
            for own, of in zip(words, found):
                if of:
                    kept = bytearray(b"\1") * len(own)
                    for start, length, period in of:
                        kept[start + period:start + length] = bytes(length - period)
                    own = compress(own, kept)
                collapsed.append(b" ".join(own).decode())
            listed = [[{"start": s, "length": n, "period": p} for s, n, p in of] for of in found]
            yield {"id": columns["id"].slice(begin, end - begin), "runs": listed, "collapsed": pa.array(collapsed, pa.string())}

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return arrow_map(rows, find, f"id {kind}, runs {RUNS}, collapsed string").withColumnRenamed("id", key)


def with_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): in texts whose key's crc32 is a multiple of ten, the words from some place on repeat
    the first of them. Which place and how many follow from the crc32, so it is the same everywhere."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int")

    made = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get("words", source(i)))
    rows = docs.select(F.col(key), F.col(text), h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumn("a", F.when(F.col("h") % 10 == 0, a)).withColumn("p", p.cast("long"))
    return rows.select(key, F.when((F.col("h") % 10 == 0) & (F.size("words") > 0), F.concat_ws(" ", made)).otherwise(F.col(text)).alias(text))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (the first of equals, then that of the smaller period) and
    SHA-256 of all runs and of the collapsed text, for each row of `periodic_runs`."""
    ranked = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("smaller"))))
    rows = found.withColumn("best", ranked)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    length, start, period = F.col("best.length"), -F.col("best.before"), -F.col("best.smaller")
    return rows.select(
        key, F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

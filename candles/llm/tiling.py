"""Benchmark decontamination by greedy string tiling.

Words are lower-cased and stripped of everything but letters, digits and underscores. A document and
a test that share a run of five words (a seed) are compared: the longest runs that both share are
marked one after another without overlap, found by running Karp-Rabin over the words not marked yet,
so that a passage whose sentences were put in another order is still covered. A document is reported
where the marked words are at least `COVERAGE` of the test.

The tests are a stated query set: they are taken in blocks of bounded size, each block's seeds are
sent to all tasks, and documents are never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, session_of, text_bytes
from candles.llm.pieces import _WHITE, factorize
from candles.llm.quality import groups

SEED, COVERAGE = 5, 0.5
#: Bytes of tests that are sent to all tasks at once.
BLOCK_BYTES = 8 << 20
FIRST_SEARCH = 20
#: Words of a generation; a task remembers two of them.
REMEMBERED = 1 << 16
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.uint64(20)
_STRIP = re.compile(r"\W+")


class Words:
    """64-bit numbers of words, remembered; 0 for what has neither letter nor digit."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def numbers(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all words one after another, words per text)."""
        buffer = b"\n".join(texts) + b"\n"
        data = np.frombuffer(buffer, np.uint8)
        white = _WHITE[data]
        first = np.flatnonzero(~white & np.append(True, white[:-1]))
        stop = np.flatnonzero(~white & np.append(white[1:], True)) + 1
        codes, words, _ = factorize(buffer, first, stop)
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, table = self.known, np.zeros(len(words), np.uint64)
        for i, word in enumerate(words):
            number = known.get(word)
            if number is None:
                number = self.older.get(word)
                if number is None:
                    bare = _STRIP.sub("", word.decode().lower())
                    number = xxhash.xxh64_intdigest(bare) or 1 if bare else 0
                known[word] = number
            table[i] = number
        made = table[codes] if len(codes) else np.zeros(0, np.uint64)
        owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), first, side="right")
        return made[made > 0], np.bincount(owner[made > 0], minlength=len(texts))


def runs(numbers: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of `length` words."""
    if len(numbers) < length:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(numbers) - length + 1, np.uint64)
    for k in range(length):
        out = out * _BASE + numbers[k:k + len(out)]
    return out


def tiles(test: list[int], text: list[int], least: int) -> list[tuple[int, int, int]]:
    """(place in test, place in text, length) of the marked runs. A negative word matches nothing."""
    used_test, used_text = [w < 0 for w in test], [w < 0 for w in text]
    marked: list[tuple[int, int, int]] = []
    search = max(least, min(FIRST_SEARCH, len(test), len(text)))
    while True:
        longest, found = _matches(test, text, used_test, used_text, search)
        if longest > 2 * search:
            search = longest
            continue
        for length in sorted(found, reverse=True):
            for i, j in found[length]:
                # What other tiles took of a run since it was found is cut off its ends.
                while length >= search and (used_test[i] or used_text[j]):
                    i, j, length = i + 1, j + 1, length - 1
                fit = 0
                while fit < length and not used_test[i + fit] and not used_text[j + fit]:
                    fit += 1
                if fit >= search:
                    used_test[i:i + fit], used_text[j:j + fit] = [True] * fit, [True] * fit
                    marked.append((i, j, fit))
        if search <= least or all(used_test):
            return marked
        search = search // 2 if search > 2 * least else least


def _free_runs(words: list[int], used: list[bool], length: int) -> Iterable[tuple[int, int]]:
    """(place, rolling hash) of the runs of `length` words without a used one."""
    base, mask = int(_BASE), (1 << 64) - 1
    top = pow(base, length, 1 << 64)
    value = free = 0
    for k, word in enumerate(words):
        if used[k]:
            value = free = 0
            continue
        value = (value * base + word) & mask
        free += 1
        if free > length:
            value = (value - words[k - length] * top) & mask
        if free >= length:
            yield k - length + 1, value


def _matches(test, text, used_test, used_text, search) -> tuple[int, dict[int, list[tuple[int, int]]]]:
    table = defaultdict(list)
    for i, value in _free_runs(test, used_test, search):
        table[value].append(i)
    longest, found = 0, defaultdict(list)
    for j, value in _free_runs(text, used_text, search):
        for i in table.get(value, ()):
            if i and j and test[i - 1] == text[j - 1] and not used_test[i - 1] and not used_text[j - 1]:
                continue  # a longer run begins one word earlier
            length = 0
            while (i + length < len(test) and j + length < len(text) and test[i + length] == text[j + length]
                   and not used_test[i + length] and not used_text[j + length]):
                length += 1
            if length >= search:
                longest = max(longest, length)
                found[length].append((i, j))
                if length > 2 * search:
                    return longest, found
    return longest, found


class Tests:
    """A block of tests with the table of its seeds."""

    def __init__(self, rows: list[tuple]):
        self.ids = [i for i, _ in rows]
        words = Words()
        self.words = [words.numbers([text.encode()])[0] for _, text in rows]
        seeds: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for at, numbers in enumerate(self.words):
            length = min(SEED, len(numbers))
            for value in set(runs(numbers, length).tolist()) if length else ():
                seeds[length][value].append(at)
        self.seeds = {length: dict(found) for length, found in seeds.items()}
        self.sorted, self.quick = {}, {}
        for length, found in self.seeds.items():
            self.sorted[length] = np.sort(np.array(list(found), np.uint64))
            self.quick[length] = np.zeros(1 << int(_BITS), bool)
            self.quick[length][self.sorted[length] >> np.uint64(64) - _BITS] = True

    def places(self, numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(places of seeds, their hashes)."""
        made = runs(numbers, length)
        at = np.flatnonzero(self.quick[length][made >> np.uint64(64) - _BITS])
        table = self.sorted[length]
        spot = np.minimum(np.searchsorted(table, made[at]), len(table) - 1)
        at = at[table[spot] == made[at]]
        return at, made[at]

    def compare(self, numbers: np.ndarray, places: dict[int, set[int]]) -> Iterable[tuple[int, list[tuple[int, int, int]]]]:
        """(test, tiles) for the tests of a document's seeds; `places` are the seeds' places by test."""
        for at, seeds in places.items():
            test = self.words[at].tolist()
            length = min(SEED, len(test))
            text: list[int] = []
            origin: list[int] = []
            for place in sorted(seeds):
                begin = max(place, origin[-1] + 1) if origin else place
                if origin and place > origin[-1] + 1:
                    text.append(-1)
                    origin.append(origin[-1])
                text += numbers[begin:place + length].tolist()
                origin += range(begin, place + length)
            yield at, [(i, origin[j], n) for i, j, n in tiles(test, text, length)]


def contaminated(
    docs: DataFrame, tests: DataFrame, key: str = "doc_id", text: str = "text", test_key: str = "item_id",
    test_text: str = "text", coverage: float = COVERAGE,
) -> DataFrame:
    """(key, test_key, coverage, n_words, spans) of documents and the tests they contain.

    `coverage` is the share of a test's words under tiles, `spans` lists the tiles' (word of the test,
    word of the document, words). A test of fewer than five words is one seed; one without words, or
    a null text on either side, matches nothing. Repeated rows on either side give repeated results.
    Very long texts are taken whole; other columns are not looked at. The documents are read once for each block of
    `BLOCK_BYTES` of tests.
    """
    spark = session_of(docs)
    kind, test_kind = (d.select(k).schema[0].dataType.simpleString() for d, k in ((docs, key), (tests, test_key)))
    out = (f"doc {kind}, test {test_kind}, coverage double, n_words long, "
           "spans array<struct<test_at: int, doc_at: int, words: int>>")
    queries = tests.select(F.col(test_key).alias("id"), F.col(test_text).alias("text")).where("text is not null")
    blocks = -(-(queries.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES)
    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    found = []
    for block in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        sent = spark.sparkContext.broadcast(sorted(((r.id, r.text) for r in own), key=repr))
        found.append(arrow_map(rows, _comparison(sent, coverage), out))
    made = reduce(DataFrame.union, found) if found else spark.createDataFrame([], out)
    return made.withColumnsRenamed({"doc": key, "test": test_key})


def _comparison(sent, coverage: float):
    held: dict[str, object] = {}

    def run(columns: dict) -> Iterable[dict]:
        if not held:
            held["tests"], held["words"] = Tests(sent.value), Words()
        tests, words = held["tests"], held["words"]
        texts, docs = text_bytes(columns["text"]), columns["doc"].to_pylist()
        made: dict[str, list] = {"doc": [], "test": [], "coverage": [], "n_words": [], "spans": []}
        for begin, end in groups(texts):
            numbers, per = words.numbers(texts[begin:end])
            ends = np.cumsum(per)
            hits: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
            for length, table in tests.seeds.items():
                at, values = tests.places(numbers, length)
                owner = np.searchsorted(ends, at, side="right")
                inside = at + length <= ends[owner]
                for place, value, doc in zip(at[inside].tolist(), values[inside].tolist(), owner[inside].tolist()):
                    for test in table[value]:
                        hits[doc][test].add(place)
            for doc, places in sorted(hits.items()):
                start = int(ends[doc] - per[doc])
                for test, marked in tests.compare(numbers, places):
                    share = sum(n for _, _, n in marked) / len(tests.words[test])
                    if share >= coverage:
                        for name, value in zip(made, (
                                docs[begin + doc], tests.ids[test], share, int(per[doc]),
                                [{"test_at": i, "doc_at": j - start, "words": n} for i, j, n in marked])):
                            made[name].append(value)
        yield made

    return run

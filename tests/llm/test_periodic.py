"""Periodic runs: against a check of every period, on small alphabets and on the query's documents."""

import hashlib
import random
import zlib

import pytest

from candles.llm import periodic
from candles.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def all_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                stretch = words[i:j + q]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    found.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def made_up(rng):
    """Texts of few words, with repeats of repeats."""
    out = []
    while len(out) < rng.randint(0, 400):
        unit = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 90))]
        if rng.random() < 0.5:
            unit = unit[:5] * rng.randint(1, 6) + unit[:2]
        out += unit * rng.randint(1, 7) + unit[:rng.randint(0, len(unit))]
    return [w.encode() for w in out]


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_all_periods(seed):
    rng = random.Random(seed)
    texts = [made_up(rng) for _ in range(12)]
    assert periodic.runs_of_texts(texts) == [all_runs(t) for t in texts]


def test_long_periods():
    rng = random.Random(1)
    texts = []
    for period in (8, 9, 16, 17, 31, 32, 33, 500, 1024, 1025, 3001):
        for extra in (-1, 0, 1):
            unit = [str(rng.random()).encode() for _ in range(period)]
            texts.append([b"x", b"y"] + (unit * 5)[:4 * period + extra] + [b"z"])
    texts += [[b"same"] * 50_000, [], [b"a"] * 5, [b"a"] * 6]
    found = periodic.runs_of_texts(texts)
    want = []
    for period in (8, 9, 16, 17, 31, 32, 33, 500, 1024, 1025, 3001):
        want += [[], [(2, 4 * period, period)], [(2, 4 * period + 1, period)]]
    assert found == want + [[(0, 50_000, 1)], [], [], [(0, 6, 1)]]


def test_a_run_around_runs():
    inner = [b"a"] * 10 + [b"b"]
    text = inner * 40
    assert periodic.runs_of_texts([text]) == [all_runs(text)]
    assert (0, 440, 11) in all_runs(text)


def test_odd_rows(spark):
    rows = [(1, None, 5, "k"), (2, "", 5, "k"), (2, "", 5, "k"), (None, " \t\n", 5, "k"), (3, "a b\v" * 8, 5, "k"), (4, "x y\tx\ry x y x y", 5, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long, runs string")
    got = {(r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.periodic_runs(docs).collect()}
    assert got == {(1, (), ""), (2, (), ""), (None, (), ""), (3, ((0, 8, 1),), "a b"), (4, ((0, 8, 2),), "x y")}
    assert periodic.periodic_runs(docs).count() == 6
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    assert periodic.digests(periodic.periodic_runs(periodic.with_repeats(docs))).count() == 6


def test_query_equals_brute_force(spark):
    def digest(text):
        return hashlib.sha256(text).hexdigest()

    want, planted = [], 0
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        words = (r.text or "").encode().split()
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        found = all_runs(words)
        planted += bool(h % 10 == 0 and found)
        best = min(found, key=lambda f: (-f[1], f[0], f[2]), default=(None,) * 3)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        want.append((r.doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
                     digest(listed.encode()), digest(b" ".join(collapse(words, found)))))
    got = sorted(map(tuple, QUERIES["op13_periodic_runs"](spark, FOLDER).collect()))
    assert planted > 5 and got == sorted(want)

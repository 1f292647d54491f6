"""Ranked lexical search: against all scores, on made-up texts of few words."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from candles.llm import lexical

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return PATTERN.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k):
    texts = [(key, terms(t)) for key, t, *_ in docs]
    texts = [(key, t) for key, t in texts if t]
    n, total = len(texts), sum(len(t) for _, t in texts)
    df = Counter(w for _, t in texts for w in set(t))
    out = []
    for item, text, *_ in items:
        scores = []
        for key, words in texts:
            tf, m = Counter(words), 100 - 50 + 50 * len(words) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1000000000 * tf[w] // (1000 * tf[w] + 20 * m))
                        for w in set(terms(text)) if tf[w])
            if score > 0:
                scores.append((-score, key is None, key or 0))
        out += [(item, i + 1, None if none else key, -s) for i, (s, none, key) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def made_up(seed, n):
    """Documents of several vocabularies, some words common to all, copies and ties among them."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        words = [f"{'abcd'[i % 4]}{min(int(rng.expovariate(0.05)), 200)}" for _ in range(rng.randint(0, 60))]
        words += ["The"] * rng.randint(0, 9)
        docs.append((i, rng.choice([" ", "-", "\n", ", "]).join(words), "x", i))
    return docs + [(n + i, docs[5][1], "x", i) for i in range(80)]


def answer(spark, docs, items, k):
    docs = spark.createDataFrame(docs, "doc_id long, text string, id string, score int")
    items = spark.createDataFrame(items, "item_id long, text string, n int")
    return sorted(map(tuple, lexical.search(docs, items, k=k).collect()), key=repr)


@pytest.mark.parametrize("shard,block", [(2048, 64), (100, 4)])
def test_equals_all_scores(spark, monkeypatch, shard, block):
    docs = made_up(1, 600)
    items = [(i, docs[i * 7][1][:200], i) for i in range(20)] + [(5, "a1 b1 THE é unknown", 1), (5, "a1 b1 THE é unknown", 1), (6, docs[5][1], 2)]
    monkeypatch.setattr(lexical, "QUERIES", 15)
    monkeypatch.setattr(lexical, "SHARD", shard)
    monkeypatch.setattr(lexical, "BLOCK", block)
    assert answer(spark, docs, items, 7) == brute(docs, items, 7)


def test_odd_rows(spark):
    docs = [(1, None, "x", 1), (2, "", "x", 1), (3, "-- ..", "x", 1), (4, "É é ÉTÉ naïve", "x", 1), (4, "É é ÉTÉ naïve", "x", 1),
            (None, "naïve a_b", "x", 1), (7, "long " * 100_000 + "tail", "x", 1), (8, "A B c1", "x", 1)]
    items = [(1, "naïve", 1), (None, "a b", 1), (2, None, 1), (3, "", 1), (4, "tail É", 1), (5, "none", 1)]
    assert answer(spark, docs, items, 5) == brute(docs, [i for i in items if i[1]], 5)
    assert answer(spark, [], items, 5) == [] == answer(spark, docs, [], 5)


def test_blocks_are_skipped(monkeypatch):
    """Bounds hold for every document of a block, and blocks below the cutoff are not scored."""
    monkeypatch.setattr(lexical, "BLOCK", 8)
    monkeypatch.setattr(lexical, "AT_ONCE", 4)
    docs = made_up(3, 1200)
    texts = [terms(t) for _, t, *_ in docs]
    kept = [(d[0], t) for d, t in zip(docs, texts) if t]
    queries = lexical.Queries([0, 1, 2], [b" ".join(w.encode() for w in kept[i][1][:12]) for i in (8, 9, 11)])
    df = Counter(w for _, t in kept for w in set(t))
    queries.weigh(len(kept), {i: df[w.decode()] for w, i in queries.code.items()})
    codes = [np.array([queries.code[w.encode()] for w in sorted(set(t)) if w.encode() in queries.code], np.int32) for _, t in kept]
    counts = [np.array([t.count(w) for w in sorted(set(t)) if w.encode() in queries.code], np.int32) for _, t in kept]
    shard = lexical.Shard.build([i for i, _ in kept], [len(t) for _, t in kept], codes, counts, len(kept), sum(len(t) for _, t in kept), queries)
    for j, columns, table in shard.lists():
        for b, summary in enumerate(table):
            rows = shard.rows[shard.begins[j] + lexical.BLOCK * b:min(shard.ends[j], shard.begins[j] + lexical.BLOCK * (b + 1))]
            assert (shard.table[np.ix_(rows, columns)].max(axis=0) == summary).all()
    cold = list(shard.search(5, np.zeros(3, np.int64)))
    warm = list(shard.search(5, np.array([np.sort(s)[-5] for _, _, s, _, _ in cold])))
    assert [set(r.tolist()) for _, r, *_ in warm] == [set(r.tolist()) for _, r, *_ in cold]
    assert sum(x[3] for x in warm) < 0.6 * sum(x[4] for x in warm)

"""Exact top-k search: against all scores."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candles.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, node int"


def brute(rows, asks, k):
    good = []
    for i, (key, vector, *_) in enumerate(rows):
        if vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            good.append((i, key, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    out = []
    for i, key, q in good:
        if key is None or not asks(key):
            continue
        scores = [(-sum(a * b for a, b in zip(q, v)), other is None, other or 0, j) for j, other, v in good if j != i and len(v) == len(q)]
        out += [(key, r + 1, None if none else other, -s) for r, (s, none, other, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def answer(spark, rows, k=5, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, topk.search(frame, F.col("vec_id") % 7 == 0, k=k, **options).collect()), key=repr)


@pytest.mark.parametrize("lists", [1, 2, 5])
def test_equals_all_scores(spark, monkeypatch, lists):
    monkeypatch.setattr(topk, "QUERIES", 40)
    rng = np.random.default_rng(lists)
    centres = rng.standard_normal((5, 12))
    rows = []
    for i in range(400):
        v = rng.standard_normal(12) if i % 3 else centres[i % 5] + 0.01 * rng.standard_normal(12)
        rows.append((i, [float(x) for x in v], "s", i))
    rows += [(1000 + i, rows[3][1], "s", i) for i in range(60)]
    assert answer(spark, rows, lists=lists) == brute(rows, lambda x: x % 7 == 0, 5)


def test_ties_nulls_and_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i % 30, [float(rng.randint(-1, 1)) for _ in range(3)], None, 1) for i in range(120)]
    rows += [(7, None, None, 1), (14, [], None, 1), (21, [], None, 1), (28, [1.0, None, 1.0], None, 1), (None, [1.0, 1.0, 1.0], None, 1),
             (35, [float("nan"), 0.0, 0.0], None, 1), (42, [float("inf"), 0.0, 0.0], None, 1), (49, [0.0, 0.0, 0.0], None, 1),
             (56, [1.0, 2.0], None, 1), (63, [3.0], None, 1), (1, [1e-9, -1e-9], None, 1)]
    got, want = answer(spark, rows), brute(rows, lambda x: x % 7 == 0, 5)
    assert got == want and (63, 1) not in {r[:2] for r in got}


def test_large_components(spark):
    rows = [(i, [float(2**18 + 7 * i), -float(2**20 - i), 1.0], None, 1) for i in range(40)]
    assert answer(spark, rows, k=3) == brute(rows, lambda x: x % 7 == 0, 3)


def test_empty_tables(spark):
    assert answer(spark, []) == []
    assert answer(spark, [(7, [1.0], None, 1)]) == []
    assert answer(spark, [(1, [1.0], None, 1), (2, [1.0], None, 1)]) == []


def test_what_a_cutoff_saves(spark):
    """Lists return a small part of all local scores."""
    rng = np.random.default_rng(0)
    unit = rng.standard_normal((4000, 64))
    unit = np.floor(256 * unit / np.linalg.norm(unit, axis=1)[:, None]).astype(np.int64)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(unit)], "node long, v array<long>")
    rows = frame.where("node < 40").collect()
    lists = topk._stored_lists(frame, 2)
    context = spark.sparkContext
    sent = context.broadcast(topk.Block(rows, 2))
    scores = unit @ unit[:40].T
    low = np.sort(np.where(np.arange(4000)[:, None] == np.arange(40), -2**40, scores), axis=0)[-5]
    entries = topk._sufficient(lists, sent, context.broadcast((low,)), 5)
    sent_back = sum(len(r.best_q) // 8 + len(r.q) // 8 for r in entries.collect())
    assert sent_back < 0.05 * 2 * scores.size

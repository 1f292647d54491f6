import random

import numpy as np
import pytest

from candles.llm import embeddings


def brute(rows, cosine=0.95):
    ok = {}
    for i, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            ok[i] = x / np.linalg.norm(x)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in ok:
        for j in ok:
            if i < j and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, links[i], least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows))


def cloud(n, dimension, seed):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dimension))
    made = [(i, v.tolist()) for i, v in enumerate(base.astype(np.float32))]
    for i in range(n):
        center = base[i % 7] / np.linalg.norm(base[i % 7])
        off = rng.standard_normal(dimension)
        off -= (off @ center) * center
        cos = rng.choice([0.93, 0.951, 0.96, 0.99, 0.9999])
        v = cos * center + np.sqrt(1 - cos * cos) * off / np.linalg.norm(off)
        made.append((n + i, (v * rng.choice([1e-6, 1.0, 1e6])).astype(np.float32).tolist()))
    return made


ODD = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [float("inf")] + [1.0] * 15),
       (905, [None] + [1.0] * 15), (906, [1.0] * 16), (907, [2.0] * 16), (908, [1.0] * 8), (909, [1.0] * 16), (910, [1.0]), (911, [-1.0])]


@pytest.mark.parametrize("rows", [cloud(150, 16, 1) + ODD, cloud(120, 64, 2), cloud(60, 3, 3), [], [(1, None)]])
def test_against_all_pairs(spark, rows):
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<float>, node int, n int")
    got = sorted(map(tuple, embeddings.near_duplicates(frame).collect()))
    want = brute(rows)
    assert len(got) == len(want)
    links = sum(w[1] for w in want)
    assert sum(g[1] for g in got) <= links
    assert sum(g[1] for g in got) >= 0.98 * links
    exact = sorted(map(tuple, embeddings.near_duplicates(frame, recall=1 - 1e-6).collect()))
    assert exact == want


def test_crowded_cells_are_sliced(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "SLICE", 16)
    rows = cloud(100, 16, 4)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, embeddings.near_duplicates(frame, recall=1 - 1e-6).collect())) == brute(rows)


def test_repeated_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0])] * 50 + [(0, [1.0, 2.0, 3.0, 4.0])] * 2 + [(5, [-1.0, 2.0, 3.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, embeddings.near_duplicates(frame).collect())) == brute(rows)

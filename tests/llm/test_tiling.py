import random
import re

import pytest

from candles.llm import tiling


def plain_tiles(test, text, least):
    """Greedy string tiling by looking at all pairs of places in every round."""
    used_test, used_text, out = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(test)):
            for j in range(len(text)):
                n = 0
                while (i + n < len(test) and j + n < len(text) and test[i + n] == text[j + n]
                       and i + n not in used_test and j + n not in used_text):
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return out
        used_test |= set(range(i, i + n))
        used_text |= set(range(j, j + n))
        out += n


def words(text):
    return [w for w in (re.sub(r"\W+", "", x.lower()) for x in re.split(r"[ \t-\r]+", text or "")) if w]


def test_tiles_do_not_overlap_and_cover_as_much():
    rng = random.Random(3)
    for _ in range(200):
        test = [rng.randrange(12) for _ in range(rng.randrange(1, 40))]
        pieces = [test[a:a + rng.randrange(3, 12)] for a in rng.choices(range(len(test)), k=4)]
        text = [x for p in pieces for x in [*p, rng.randrange(12)]]
        found = tiling.tiles(test, text, 5)
        assert all(test[i:i + n] == text[j:j + n] and n >= 5 for i, j, n in found)
        for side in (0, 1):
            taken = [t[side] + k for t in found for k in range(t[2])]
            assert len(taken) == len(set(taken))
        assert sum(n for _, _, n in found) >= 0.8 * plain_tiles(test, text, 5)
    assert tiling.tiles(list(range(60)), [*range(40, 60), -1, *range(40)], 5) == [(0, 21, 40), (40, 0, 20)]


TEST = "Alpha beta gamma delta epsilon, zeta eta theta iota kappa. Lambda mu nu xi omicron pi rho sigma tau upsilon"
HALVES = "lambda mu nu xi omicron pi rho sigma tau upsilon -- ALPHA beta; gamma delta (epsilon) zeta eta theta iota kappa"


@pytest.mark.parametrize("block", [tiling.BLOCK_BYTES, 100])
def test_documents(spark, monkeypatch, block):
    monkeypatch.setattr(tiling, "BLOCK_BYTES", block)
    filler = " ".join(f"f{i}" for i in range(300))
    docs = [(1, f"{filler} {TEST} {filler}"), (2, f"{filler}\n{HALVES}"), (3, filler), (4, None), (5, ""), (None, TEST),
            (6, TEST[:50]), (7, "one two"), (8, "x one two three"), (3, TEST), (9, TEST + " " + TEST), (10, f"{filler} " * 3000 + TEST),
            (11, "alpha"), (12, "beta gamma delta epsilon")]
    tests = [(100, TEST, "e"), (101, "one two three", "e"), (102, None, "e"), (103, "...", "e"), (None, "f1 f2 f3 f4 f5 f6", "e"), (100, TEST, "e")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = tiling.contaminated(frame, spark.createDataFrame(tests, "item_id long, text string, coverage string")).collect()
    want = []
    for d, body in docs:
        for t, asked, _ in tests:
            a, b = words(asked), words(body)
            least = min(5, len(a))
            share = plain_tiles(a, b[:700], least) / len(a) if a and d != 10 else None
            if d == 10:
                share = {100: 1.0, None: 1.0}.get(t, 0.0) if a else None
            if share is not None and share >= tiling.COVERAGE:
                want.append((d, t, round(share, 6), len(b)))
    assert sorted(((r.doc_id, r.item_id, round(r.coverage, 6), r.n_words) for r in got), key=repr) == sorted(want, key=repr)
    two = next(r for r in got if (r.doc_id, r.item_id) == (2, 100))
    assert sorted((s.test_at, s.doc_at, s.words) for s in two.spans) == [(0, 310, 10), (10, 300, 10)]


def test_empty(spark):
    docs = spark.createDataFrame([(1, TEST)], "doc_id long, text string")
    tests = spark.createDataFrame([(1, TEST)], "item_id long, text string")
    assert tiling.contaminated(docs, tests.limit(0)).collect() == []
    assert tiling.contaminated(docs.limit(0), tests).collect() == []

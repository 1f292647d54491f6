import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candles.llm import simhash
from candles.llm.common import stored

A = "the quick brown fox jumps over the lazy dog and runs far away from here today"


def brute(rows):
    """component_id per row from all pairs of fingerprints."""
    prints = [simhash.fingerprint((t or "").encode()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted((str(k), f"{p:016x}", least.get(find(i))) for i, ((k, _), p) in enumerate(zip(rows, prints)))


def test_fingerprint_by_the_definition():
    import xxhash

    words = "a b c A b c d".lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]), 42) for i in range(5)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 5)
    assert simhash.fingerprint(b"a  b\tc\nA b c d") == want
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \n") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest("one two", 42)
    assert simhash.fingerprint("É\u00a0x".encode()) == xxhash.xxh64_intdigest("É\u00a0x", 42)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('one two three')").first()[0] % 2**64 == simhash.fingerprint(b"one two three")


def test_every_word_has_one_home_and_anchors_cover_pairs():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.choice([1, 2])):
            b ^= 1 << bit
        rows, anchors, homes = simhash.anchors_of(np.array([a, b], np.uint64))
        assert homes[rows == 0].sum() == homes[rows == 1].sum() == 1
        assert anchors[(rows == 0) & homes][0] in anchors[rows == 1]
        assert len(set(anchors[rows == 0])) == (rows == 0).sum()


def test_links_equal_all_pairs(spark):
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    fps = sorted({s ^ sum(1 << b for b in rng.sample(range(64), k)) for s in seeds for k in (0, 1, 1, 2, 2, 3, 4)})
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    got = {tuple(sorted(r)) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {(x, y) for x in signed for y in signed if x < y and ((x ^ y) % 2**64).bit_count() <= 2}
    assert got == want


@pytest.mark.parametrize("rows", [
    [],
    [(1, None), (2, ""), (3, " "), (4, A), (4, A), (None, A), (None, "x y z"), (9, "x y z w")],
    [(i, A + " " + " ".join(f"w{j}" for j in range(i % 7))) for i in range(40)],
    [(1, "w " * 200_000), (2, "w " * 100_000), (0, "w")],
])
def test_components_equal_brute_force(spark, rows):
    docs = spark.createDataFrame([(k, t, "c") for k, t in rows], "doc_id long, text string, fp string")
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == brute(rows)


def test_replicas_are_never_sent_whole(spark):
    """A fingerprint has some 61 replicas, which Spark counts as one row."""
    fps = stored(spark.range(1000).select(F.xxhash64("id").alias("fp")), "fps")
    plan = simhash.links(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan

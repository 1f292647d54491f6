import zlib
from collections import Counter

import pytest

from candles.llm import sharding


def plain_jump(key, shards):
    key, at, after = (key or 0) % 2**64, -1, 0
    while after < shards:
        at = after
        key = (key * sharding.MULTIPLIER + 1) % 2**64
        after = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


@pytest.mark.parametrize("shards", [1, 2, 16, 17, 500])
def test_jump_equals_the_loop(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -2**63, None, *range(1000, 1100)]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", sharding.jump(sharding.F.col("k"), shards))
    assert all(b == plain_jump(a, shards) for a, b in got.collect())


def test_shards_slots_and_growth(spark):
    rows = [(i, "é" * (i % 5), "x") for i in range(3000)] + [(7, "copy", "y")] * 1500 + [(None, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(8)
    got = sharding.shard(docs, 16).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.law == "key" and r.shard == plain_jump(r.doc_id, 16)
        assert r.grown_shard in (r.shard, 16)
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_empty(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string"), 16).collect() == []

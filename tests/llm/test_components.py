import random

from candles.llm import components as module
from candles.llm.components import components


def test_chains_stars_and_cliques(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)]
    edges += [(a, b) for a in range(200, 210) for b in range(200, 210)] + [(300, 300), (None, 4), (5, None)]
    rng.shuffle(edges)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {i: 200 for i in range(200, 210)}
    assert got == want


def test_empty(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_stars_take_no_round(spark, monkeypatch):
    """What is known to be components is written once; a chain is written again for each round."""
    written, stored = [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: written.append(name) or stored(df, name))
    stars = [(0, i) for i in range(1, 9)] + [(i, 20) for i in range(21, 30)] + [(20, 25), (7, 7)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(stars, "a long, b long")).collect())
    assert got == {i: 0 for i in range(9)} | {i: 20 for i in range(20, 30)} and len(written) == 1
    # Two stars that meet at a leaf, and a root that hangs on another one.
    for more in ((8, 25), (0, 20)):
        written.clear()
        got = dict(tuple(r) for r in components(spark.createDataFrame([*stars, more], "a long, b long")).collect())
        assert set(got.values()) == {0} and len(got) == 19 and len(written) > 1

import itertools

import numpy as np

from candles.llm import crf, quality

FOLDER = "/root/testdata/sf0.01"


def all_paths(scores, model):
    """(marginals, best labels) of one sequence from every labelling."""
    n, k = scores.shape
    weight = {}
    for path in itertools.product(range(k), repeat=n):
        total = model.first[path[0]] + model.last[path[-1]] + sum(scores[t, path[t]] for t in range(n))
        weight[path] = total + sum(model.moves[a, b] for a, b in zip(path, path[1:]))
    z = sum(np.exp(w) for w in weight.values())
    marginals = np.zeros((n, k))
    for path, w in weight.items():
        for t, label in enumerate(path):
            marginals[t, label] += np.exp(w) / z
    return marginals, max(weight, key=weight.get)


def test_recursions_equal_every_path():
    rng = np.random.default_rng(1)
    model = crf.Model(rng.normal(size=(1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3), rng.normal(size=3))
    lengths = np.array([3, 0, 1, 5, 2, 0])
    scores = rng.normal(size=(lengths.sum(), 3))
    marginals, _, _ = crf.forward_backward(scores, lengths, model)
    labels = crf.viterbi(scores, lengths, model)
    at = 0
    for n in lengths:
        if n:
            want, best = all_paths(scores[at:at + n], model)
            assert np.allclose(marginals[at:at + n], want)
            assert labels[at:at + n].tolist() == list(best)
        at += n
    assert crf.viterbi(np.zeros((0, 3)), np.array([0, 0]), model).tolist() == []


def test_training_learns_a_chain():
    rng = np.random.default_rng(2)
    labels = np.repeat(rng.integers(0, 2, 50), 20)
    features = np.column_stack([np.ones(1000), labels + rng.normal(size=1000)])
    lengths = np.full(25, 40)
    model = crf.train(features, labels, lengths, 2)
    right = (crf.viterbi(features @ model.weights, lengths, model) == labels).mean()
    alone = ((features[:, 1] > 0.5) == labels).mean()
    assert right > 0.85 > alone
    assert crf.train(features[:0], labels[:0], lengths[:0], 2).weights.shape == (2, 2)


def test_line_features_do_not_depend_on_company():
    texts = ["One line.\nTWO!! TWO!! TWO!!\n\n  \nthree", "", "\n", "É É é x", "a|b 12 ... no no no no", "x" * 9000, "solo"]
    whole, sizes, per = quality.lines_of([t.encode() for t in texts])
    assert per.tolist() == [3, 0, 0, 1, 1, 1, 1] and whole.shape[1] == quality.FEATURES
    alone = [quality.lines_of([t.encode()]) for t in texts]
    assert np.allclose(whole, np.concatenate([a[0] for a in alone]))
    assert np.allclose(sizes, np.concatenate([a[1] for a in alone]))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    model, empty = quality.fit(docs, labels.where(~quality.held_out()))
    scored = quality.score(docs, model, empty).join(labels, "doc_id").where(quality.held_out()).collect()
    assert len(scored) > 50
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in scored]) >= 0.97
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.99


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (2, " \n\t", "c"), (None, "A line of words.", None), (3, "w " * 300_000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([(9, 1), (1, None)], "doc_id long, quality int")
    model, empty = quality.fit(docs, none)
    assert empty == 0.5 and {r.score for r in quality.score(docs, model, empty).collect()} == {0.5}
    got = quality.score(docs, model, 0.25).collect()
    assert len(got) == 5 and sorted(r.score for r in got) == [0.25] * 3 + [0.5] * 2
    assert quality.score(docs.limit(0), model, empty).collect() == []
    assert not spark.createDataFrame([(None,)], "doc_id long").select(quality.held_out()).first()[0]


def test_empty_texts_score_the_share_of_all_labels(spark):
    docs = spark.createDataFrame([(k, f"Line {k} of words.\nOne more.") for k in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 6)) for k in range(8)] + [(k, 0) for k in range(90, 99)], "doc_id long, quality int")
    for sample in (1500, 2):
        assert quality.fit(docs, labels, sample)[1] == 0.75


def test_only_real_ends_teach_first_and_last(spark, monkeypatch):
    rng = np.random.default_rng(3)
    labels = np.tile(np.repeat([0, 1, 0], [1, 38, 1]), 20)
    features = np.column_stack([np.ones(800), rng.normal(size=800)])
    cut, real = np.full(80, 10), np.arange(80) % 4
    pieces = crf.train(features, labels, cut, 2, opens=real == 0, closes=real == 3)
    for ends in (pieces.first, pieces.last):
        assert ends[0] - ends[1] > 1
    blind = crf.train(features, labels, cut, 2, opens=real < 0, closes=real < 0)
    assert not blind.first.any() and not blind.last.any()
    seen = {}
    monkeypatch.setattr(quality, "train", lambda *a, **b: seen.update(b, lengths=a[2]) or quality.Model.empty(3 * quality.FEATURES, 2))
    texts = ["line\n" * 130, "", "line\n" * 64, "line"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    quality.fit(docs, docs.selectExpr("doc_id", "1 as quality"))
    assert seen["lengths"].tolist() == [64, 64, 2, 64, 1]
    assert seen["opens"].tolist() == [True, False, False, True, True]
    assert seen["closes"].tolist() == [False, False, True, True, True]

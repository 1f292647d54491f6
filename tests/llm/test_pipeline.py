import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from candles.llm import common, pieces, pii, quality

FOLDER = "/root/testdata/sf0.001"


def plain_words(text):
    import re

    return [w for w in (re.sub(r"\W+", "", x.lower()) for x in re.split(r"[ \t-\r]+", text or "")) if w]


def covered(test, text):
    """Share of a test's words in runs of five or more that the text has, wherever they stand."""
    grams = {tuple(text[i:i + 5]) for i in range(len(text) - 4)}
    hit = {k for i in range(len(test) - 4) if tuple(test[i:i + 5]) in grams for k in range(i, i + 5)}
    return len(hit) / len(test)


def five_words(text):
    """Five-word shingles; a shorter text is one shingle."""
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


@pytest.fixture(scope="module")
def expected(spark):
    read = lambda name: pq.read_table(f"{FOLDER}/{name}.parquet").to_pylist()
    docs = read("documents")
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model, empty = quality.fit(frame, spark.read.parquet(f"{FOLDER}/labels.parquet").where(~quality.held_out()))
    kept = []
    for d in docs:
        features, weights, per = quality.lines_of([d["text"].encode()])
        marginals, _, _ = quality.forward_backward(quality.with_neighbours(features, per) @ model.weights, per, model)
        good = float(np.average(marginals[:, 1], weights=weights)) if len(weights) else empty
        if good >= 0.5:
            kept.append(d)
    sets = [five_words(d["text"]) for d in kept]
    root = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {}
    for r, d in zip(root, kept):
        least[r] = min(least.get(r, d["doc_id"]), d["doc_id"])
    kept = [d for r, d in zip(root, kept) if least[r] == d["doc_id"]]
    tests = [plain_words(t["text"]) for t in read("benchmark")]
    kept = [d for d in kept if max(covered(t, plain_words(d["text"])) for t in tests) < 0.5]
    out, tokenizer = [], Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    for d in kept:
        text = d["text"]
        for kind, a, e in reversed(pii.spans_of([text.encode()])[0][1]):
            text = f"{text[:a]}[{kind}]{text[e:]}"
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        out.append((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return len(docs), sorted(out)


def test_run_equals_brute_force(spark, expected):
    total, want = expected
    got = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect()))
    assert got == want and 0 < len(got) < total


def test_stages_keep_columns_and_take_odd_rows(spark):
    rows = [(1, "A good line of words here.", "en", "s", 26, "x"), (None, "A good line of words here.", None, None, None, "y"),
            (2, None, None, None, None, None), (2, "", "en", "s", 0, None), (1, "A good line of words here.", "en", "s", 26, "x"),
            (None, "Call +1 (212) 555-0147 now please, or never again.", "en", None, 5, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for frame in (docs, docs.limit(0)):
            made = stage(spark, frame, FOLDER)
            assert made.columns == docs.columns
            assert made.count() <= len(rows)
    once = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()
    assert sorted((str(r.doc_id), r.text is None or r.text == "") for r in once) == [("1", False), ("2", True), ("None", False)]
    clean = corpus_pipeline.remove_personal_data(spark, docs, FOLDER).collect()
    assert any(r.text == "Call [phone] now please, or never again." and r.n_chars == 40 for r in clean)
    assert corpus_pipeline.tokenize(spark, docs, FOLDER).count() == len(rows)


@pytest.mark.parametrize("name", ["_id", "_score", "score", "SCORE", "spans", "base_spans", "node", "fp", "key", "id", "doc", "k", "good"])
def test_columns_of_any_name_stay_as_they_are(spark, name):
    rows = [(1, "A good line of words here, the first one.", "en", "s", 26, "x"), (2, "Call +1 (212) 555-0147 now please, or never again.", "en", "s", 5, "y"),
            (3, None, "en", "s", None, None)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, `{name}` string")
    for stage_name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, FOLDER)
        assert made.columns == docs.columns and made.dtypes == docs.dtypes, stage_name
        assert {(r.doc_id, r[name]) for r in made.collect()} <= {(1, "x"), (2, "y"), (3, None)}
    assert corpus_pipeline.tokenize(spark, docs, FOLDER).count() == 3


def test_very_long_texts(spark):
    """Texts of a long line, of many lines, and of one long word, through every stage."""
    texts = ["A good line of words here, quite long. " * 9000, "A good line of words here.\n" * 20_000, "x" * 400_000, "1." * 200_000]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() <= 4
    assert corpus_pipeline.tokenize(spark, docs, FOLDER).count() == 4


def test_only_the_result_stays(spark):
    import os

    from candles.session import scratch_root

    before = set(os.listdir(scratch_root(spark)))
    corpus_pipeline.run(spark, FOLDER)
    assert {f.split("-")[0] for f in set(os.listdir(scratch_root(spark))) - before} == {"bpe"}


def test_a_worker_holds_the_memory_of_one_stage():
    first = pii.tagger()
    assert pii.tagger() is first
    encode = pieces.encoder(corpus_pipeline.TOKENIZER)
    assert pieces.encoder(corpus_pipeline.TOKENIZER) is encode
    assert list(common._held.values()) == [encode] and pii.tagger() is not first


def test_registered():
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in entry.queries() if name.startswith("op")}

import hashlib
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candles.llm import bpe, pieces, token_orc

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "Z", "é", "ß", "×", "÷", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x85", "\xa0", "　", " ",
            "1", "²", "½", "'", "'s", "'re ", "don't", ".", ",", "...", "…", "-", "$", "日本", "й", "👍🏽", "\x00",
            "\x1c", "word", "The ", " and", "<|endoftext|>", "<|endoftext", "|>", "é", "​", "﻿", "᠎"]


def texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(1, 30))) for _ in range(n)] + ["", " ", "\n", "x" * 5000, "a1 " * 3000]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_pieces_encode_like_whole_texts(plain, monkeypatch):
    made = texts(4000)
    for section in (1 << 22, 40):
        monkeypatch.setattr(pieces.sections, "__defaults__", (section,))
        flat, counts = pieces.Encoder(PATH).encode([t.encode() for t in made])
        ends = np.cumsum(counts)
        want = plain.encode_batch(made, add_special_tokens=False)
        for t, a, b, w in zip(made, ends - counts, ends, want):
            assert flat[a:b].tolist() == w.ids, t


def test_forgetting_pieces(plain, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 50)
    encode = pieces.Encoder(PATH)
    for t in texts(200, 6):
        assert encode.encode([t.encode()])[0].tolist() == plain.encode(t, add_special_tokens=False).ids


def test_factorize_survives_equal_hashes(monkeypatch):
    monkeypatch.setattr(pieces, "_MULTIPLIERS", [np.uint64(0)] * 4)
    buffer = b"abcabcabd" + b"y" * 40 + b"y" * 39 + b"z"
    starts, ends = np.array([0, 3, 6, 9, 49]), np.array([3, 6, 9, 49, 89])
    codes, words, hashes = pieces.factorize(buffer, starts, ends)
    assert [words[c] for c in codes] == [b"abc", b"abc", b"abd", b"y" * 40, b"y" * 39 + b"z"]
    assert len(words) == len(hashes) == 4


ROWS = [(i, t, "s") for i, t in enumerate(texts(300, 7))] + [(None, "null key", "s"), (500, None, "s"), (7, "again", "s"), (7, "again", "s")]


def test_round_trip_over_blocks(spark, plain, monkeypatch):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids string").repartition(5)
    got = bpe.digests(bpe.transcode(docs, PATH, packed_ids=True)).collect()
    lists = bpe.transcode(docs, PATH).collect()
    assert sorted((r.ids for r in lists), key=repr) == sorted((plain.encode(t or "", add_special_tokens=False).ids for _, t, _ in ROWS), key=repr)
    assert sorted(r.decoded for r in lists) == sorted(t or "" for _, t, _ in ROWS)
    want = []
    for k, t, _ in ROWS:
        ids = plain.encode(t or "", add_special_tokens=False).ids
        back = plain.decode(ids, skip_special_tokens=False)
        want.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_orc_files(spark, plain, tmp_path):
    path = str(tmp_path / "ids")
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, ids string").repartition(5)
    token_orc.write_tokens(docs, path, PATH, 2)
    tokens = token_orc.read_tokens(spark, path)
    got = token_orc.digests(tokens).collect()
    ids = {}
    for k, t, _ in ROWS:
        ids.setdefault(k, []).append(plain.encode(t or "", add_special_tokens=False).ids + [2])
    assert len(got) == len(ROWS)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        match = [x for x in ids[r.doc_id] if (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) == (r.n_tokens, r.ids_crc32)]
        assert r.start == start and match
        ids[r.doc_id].remove(match[0])
        start += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: -1 if k is None else k)
    assert tokens.where("doc_id = 42").select("ids").collect()[0][0] == plain.encode(ROWS[42][1], add_special_tokens=False).ids + [2]


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.transcode(docs, PATH).collect() == []
    token_orc.write_tokens(docs, str(tmp_path / "none"), PATH, 2)
    assert token_orc.read_tokens(spark, str(tmp_path / "none")).collect() == []


def test_files_hold_run_lengths_row_indexes_and_bloom_filters(spark, tmp_path):
    """What the footers say, and that a lookup by id reads a small part of the rows."""
    rows = [(3 * i, f"word {i} and some more words of document {i % 7}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    token_orc.write_tokens(docs, f"{tmp_path}/t", PATH, 2)
    orc = spark._jvm.org.apache.orc
    found = [f for f in os.listdir(f"{tmp_path}/t") if f.endswith(".orc")]
    kinds, encodings, strides = set(), set(), set()
    for name in found:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{tmp_path}/t/{name}")
        reader = orc.OrcFile.createReader(path, orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
        strides.add(reader.getRowIndexStride())
        batches = reader.rows()
        for stripe in reader.getStripes():
            footer = batches.readStripeFooter(stripe)
            kinds |= {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
            encodings |= {c.getKind().toString() for c in footer.getColumnsList()}
        batches.close()
        reader.close()
    columns = ["struct", "doc_id", "row", "before", "n", "ids", "id"]
    assert strides == {token_orc.INDEX_ROWS} and "DIRECT_V2" in encodings
    assert {c for c, kind in kinds if kind == "ROW_INDEX"} == set(range(len(columns)))
    assert {columns[c] for c, kind in kinds if kind.startswith("BLOOM_FILTER")} == {"doc_id"}
    for wanted, there in ((12_000, 1), (12_001, 0)):
        one = spark.read.orc(f"{tmp_path}/t").where(f"doc_id = {wanted}")
        assert len(one.collect()) == there
        scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        assert scan.metrics().apply("numOutputRows").value() <= (token_orc.INDEX_ROWS if there else 0)

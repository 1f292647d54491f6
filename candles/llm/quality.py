"""Document quality by a linear-chain conditional random field over lines.

A document's lines are a sequence of good and bad ones. What is known of a line is how it is made
(shares of capitals, digits, marks and repeated words, lengths), and the same of the lines before and
after it. Lines are trained with the label of their document. A document's score is the mean of its
lines' forward-backward marginals of `good`, weighted by the lines' bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, session_of, text_bytes
from candles.llm.crf import Model, forward_backward, train
from candles.llm.pieces import factorize

#: Labelled documents of each class that a model is fitted on, the only bound on what is read.
SAMPLE = 1500
#: Lines of a sequence in training (scores always see whole documents), and steps of the training.
PIECE, ROUNDS = 64, 120
GROUP_BYTES = 4 << 20
FEATURES = 15
GOOD = 1

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 blank, 2 lower, 3 upper, 4 digit, 5 full stops, 6 other marks, 7 inner byte
_KIND[[32, 9, 11, 12, 13]] = 1
_KIND[range(97, 123)], _KIND[range(65, 91)], _KIND[range(48, 58)] = 2, 3, 4
_KIND[[b for b in range(33, 127) if not _KIND[b]]] = 6
_KIND[[ord(c) for c in ".,;:'?-()\""]] = 5
_KIND[range(128, 192)] = 7


def groups(texts: list[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about `limit` bytes; a longer document is a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def lines_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, bytes of each line, lines per text). Lines end at line feeds; those
    without any byte but white space are left out, so an empty text has none."""
    buffer = b"\n".join(texts) + b"\n"
    data = np.frombuffer(buffer, np.uint8)
    ends = np.flatnonzero(data == 10)
    begins = np.append(0, ends[:-1] + 1)
    lengths = ends - begins
    last = np.cumsum([len(t) + 1 for t in texts]) - 1
    text_of = np.searchsorted(last, ends)
    kinds = _KIND[data]
    kinds[ends] = 1
    # Latin-1 letters in two bytes: capitals are C3 80 to C3 9E.
    second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80)) + 1
    kinds[second - 1] = np.where(data[second] < 0x9F, 3, 2)
    counts = np.stack([np.add.reduceat(kinds == k, begins, dtype=np.int64) for k in range(8)], 1).astype(float)
    counts[:, 1] -= 1
    blank = kinds == 1
    first = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    stop = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    words, line_of = stop - first, np.searchsorted(ends, first)
    codes = factorize(buffer, first, stop)[0]
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (line_of[1:] == line_of[:-1])
    marked = (kinds[stop - 1] == 6) if len(stop) else same
    n = np.bincount(line_of, minlength=len(ends)).astype(float)
    per = lambda values: np.bincount(line_of, values, minlength=len(ends)) / np.maximum(n, 1)
    chars = np.maximum(counts.sum(axis=1) - counts[:, 1] - counts[:, 7], 1)
    share = counts / chars[:, None]
    features = np.column_stack([
        np.ones(len(ends)), share[:, 3], share[:, 4], share[:, 5], share[:, 6], share[:, 0], share[:, 1],
        share[:, 3] > 0.5, share[:, 6] > 0.04, per(same.astype(float)), per(same.astype(float)) > 0.2, per(marked.astype(float)),
        np.clip(per(words.astype(float)) / 20, 0, 3), np.log1p(n) / 10, per(kinds[np.minimum(first, len(kinds) - 1)] == 3) if len(first) else n])
    kept = n > 0
    return features[kept], lengths[kept].astype(float), np.bincount(text_of[kept], minlength=len(texts))


def with_neighbours(features: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and of the line after; at an end zeros."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    ends = np.cumsum(per_text)
    before[(ends - per_text)[per_text > 0]] = 0
    after[ends[per_text > 0] - 1] = 0
    return np.hstack([features, before, after])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", text: str = "text",
        label: str = "quality") -> tuple[Model, float]:
    """(model, score of a text without lines), from at most `sample` documents of either class.

    Documents are chosen by a hash of the key. Labels that are null or neither 0 nor 1 and labels of
    unknown documents do not count; without any, every score is 0.5. A text without lines scores the
    share of good ones among all labels that count, whatever the sample.
    """
    session_of(docs)
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).alias("good"))
    counted = known.distinct().join(docs.select(F.col(key).alias("k")), "k", "left_semi")
    share = counted.agg(F.avg("good")).first()[0]
    chosen = [known.where(F.col("good") == c).orderBy(F.xxhash64("k"), "k").limit(sample) for c in (0, 1)]
    chosen = chosen[0].union(chosen[1]).dropDuplicates(["k"])
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(chosen), "k")

    def run(columns: dict) -> Iterable[dict]:
        goods = columns["good"].to_pylist()
        texts = text_bytes(columns["text"])
        for begin, end in groups(texts):
            features, _, per = lines_of(texts[begin:end])
            parts = np.split(features.astype("<f4"), np.cumsum(per)[:-1])
            yield {"k": columns["k"].slice(begin, end - begin).cast(pa.string()), "good": goods[begin:end], "lines": [p.tobytes() for p in parts]}

    found = arrow_map(rows, run, "k string, good int, lines binary").orderBy("k", "lines").collect()
    if not found:
        return Model.empty(3 * FEATURES, 2), 0.5
    parts = [np.frombuffer(r.lines, "<f4").reshape(-1, FEATURES).astype(float) for r in found]
    per = np.array([len(p) for p in parts])
    goods = np.repeat([r.good for r in found], per)
    # Long documents are trained in pieces: a step of the recursions then serves many sequences.
    pieces = np.concatenate([np.diff(np.append(np.arange(0, n, PIECE), n)) for n in per])
    number = -(-per[per > 0] // PIECE)
    opens, closes = np.zeros((2, len(pieces)), bool)
    opens[np.cumsum(number) - number] = closes[np.cumsum(number) - 1] = True
    model = train(with_neighbours(np.concatenate(parts), per), goods, pieces, 2, rounds=ROUNDS, opens=opens, closes=closes)
    return model, share


def score(docs: DataFrame, model: Model, empty: float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of `docs` and `score`: 0 to 1, higher for better; a text without lines (null,
    empty or blank) scores `empty`. Repeated rows are scored like any; a very long text or line is scored
    whole. A column `score` of `docs` is replaced."""
    session_of(docs)

    def run(columns: dict) -> Iterable[dict]:
        texts = text_bytes(columns[text])
        for begin, end in groups(texts):
            features, weights, per = lines_of(texts[begin:end])
            marginals, _, _ = forward_backward(with_neighbours(features, per) @ model.weights, per, model)
            owner = np.repeat(np.arange(end - begin), per)
            sums = np.bincount(owner, weights, minlength=end - begin)
            good = np.bincount(owner, weights * marginals[:, GOOD], minlength=end - begin)
            made = np.where(sums > 0, np.clip(good / np.maximum(sums, 1e-300), 0, 1), empty)
            yield {name: column.slice(begin, end - begin) for name, column in columns.items()} | {"score": made}

    rows = docs.drop("score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return arrow_map(rows, run, f"{schema}, score double")


def held_out(key: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))

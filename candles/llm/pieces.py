"""Cutting texts into pieces that a byte-level BPE tokenizer encodes one by one.

A byte-level tokenizer first splits a text with its own pattern and encodes the parts alone, so a
text may be cut wherever the pattern always has a boundary, and equal pieces need encoding once.
The cuts made here are a subset of those boundaries, chosen so that bytes alone decide them:

* before ASCII white space that follows something that is not white space;
* after a single tab or line feed between two things that are not white space;
* before ASCII punctuation that follows an ASCII letter or digit or a letter of U+00C0 to U+00FF.

Strings of added tokens are never cut. A tokenizer of another kind gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
import xxhash

from candles.llm.common import held_alone

#: Bytes worked on at once; a longer text is taken in several parts.
SECTION = 4 << 20
#: Distinct pieces of a generation. A worker remembers two of them: what the newer one lacks is taken over from the
#: older one, which is dropped when the newer is full, so pieces that come often stay.
REMEMBERED = 1 << 17

_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not _ALNUM[b]]] = True
#: First bytes of characters among which Unicode has white space.
_DOUBTFUL = np.zeros(256, bool)
_DOUBTFUL[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LANES = len(_MULTIPLIERS)


def sections(texts: list[bytes], limit: int = SECTION) -> Iterator[tuple[list[int], list[bytes]]]:
    """(document numbers, parts) of about `limit` bytes; a text over the limit is cut after a
    letter or digit that a blank follows."""
    numbers, parts, size = [], [], 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            cut = len(text)
            if cut - at > limit:
                found = re.compile(rb"[A-Za-z0-9](?= )").search(text, at + limit)
                cut = found.end() if found else cut
            numbers.append(number)
            parts.append(text[at:cut] if at or cut < len(text) else text)
            size += cut - at
            at = cut
            if size >= limit:
                yield numbers, parts
                numbers, parts, size = [], [], 0
            if at >= len(text):
                break
    if parts:
        yield numbers, parts


def cut_points(buffer: bytes, begins: np.ndarray, whole: tuple[bytes, ...] = ()) -> np.ndarray:
    """Where the pieces of joined texts begin; `begins` is where the texts do."""
    b = np.frombuffer(buffer, np.uint8)
    n = len(b)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        white = _WHITE[b]
        after = np.flatnonzero(white[1:] & ~white[:-1]) + 1
        far = after[b[after - 1] >= 0x80]
        if len(far):
            one, two, three = (b[np.maximum(far - k, 0)] for k in (2, 3, 4))
            lead = np.where(one >= 0xC0, one, np.where(two >= 0xC0, two, three))
            cut[far[~_DOUBTFUL[lead]]] = True
        cut[after[b[after - 1] < 0x80]] = True
        line = np.flatnonzero(cut[1:n - 1] & (b[1:n - 1] != 32)) + 2
        line = line[~white[line] & ~_DOUBTFUL[b[line]]]
        cut[line] = True
        marks = np.flatnonzero(_PUNCT[b[1:]]) + 1
        before = b[marks - 1]
        letter = (b[np.maximum(marks - 2, 0)] == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7)
        cut[marks[_ALNUM[before] | letter]] = True
    for token in whole:
        at = buffer.find(token)
        while at >= 0:
            cut[at + 1:at + len(token)] = False
            at = buffer.find(token, at + len(token))
    cut[begins] = True
    return np.flatnonzero(cut[:n])


def factorize(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(code of each slice, distinct slices, a 64-bit hash of each that its bytes alone decide).

    Slices of up to 32 bytes are compared as four 64-bit numbers, so equal codes are equal bytes.
    """
    if not len(starts):
        return np.zeros(0, np.int64), [], np.zeros(0, np.uint64)
    padded = buffer + bytes(8 * _LANES)
    view = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    lengths = ends - starts
    lanes = [view[starts + 8 * k] & _MASKS[np.clip(lengths - 8 * k, 0, 8)] for k in range(_LANES)]
    for i in np.flatnonzero(lengths > 8 * _LANES):
        lanes[0][i] = xxhash.xxh64_intdigest(buffer[starts[i]:ends[i]])
    mixed = lengths.astype(np.uint64)
    for lane, multiplier in zip(lanes, _MULTIPLIERS):
        mixed = (mixed ^ lane) * multiplier
        mixed ^= mixed >> np.uint64(31)
    codes, hashes = pd.factorize(mixed)
    first = np.empty(len(hashes), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    same = all((lane == lane[first][codes]).all() for lane in [*lanes, lengths])
    long = lengths > 8 * _LANES
    if same and long.any():
        same = all(buffer[starts[i]:ends[i]] == buffer[starts[j]:ends[j]]
                   for i, j in zip(np.flatnonzero(long), first[codes[long]]))
    if not same:
        seen: dict[bytes, int] = {}
        codes = np.array([seen.setdefault(buffer[a:e], len(seen)) for a, e in zip(starts, ends)], np.int64)
        first = np.empty(len(seen), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        hashes = mixed[first]
    words = [buffer[a:e] for a, e in zip(starts[first].tolist(), ends[first].tolist())]
    return codes, words, hashes


class Encoder:
    """Encodes texts piece by piece and remembers the ids of pieces."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        added = parts.get("added_tokens") or []
        pre = parts.get("pre_tokenizer") or {}
        self.cuttable = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and parts.get("normalizer") is None and parts["model"].get("dropout") is None
            and not any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or re.search(r"\s", a["content"]) for a in added))
        self.whole = tuple(a["content"].encode() for a in added)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.counts, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), 0
        self.begins = np.zeros(1 << 14, np.int64)
        self.older: tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray] | None = None

    def age(self) -> None:
        """Begin a generation; the one so far becomes the older one."""
        older = self.known, self.ids, self.begins, self.counts
        self.forget()
        self.older = older

    def learn(self, words: list[bytes], flat: np.ndarray, counts: np.ndarray) -> int:
        """Remember these pieces, whose ids stand one after another; the number of the first."""
        at = len(self.known)
        while self.size + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while at + len(words) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.ids[self.size:self.size + len(flat)] = flat
        self.counts[at:at + len(words)] = counts
        self.begins[at:at + len(words)] = self.size + np.cumsum(counts) - counts
        self.size += len(flat)
        self.known.update(zip(words, range(at, at + len(words))))
        return at

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]

    def split(self, parts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
        """(codes, distinct pieces, their hashes, pieces per part) of texts."""
        buffer = b"".join(parts)
        lengths = np.array([len(p) for p in parts], np.int64)
        begins = (np.cumsum(lengths) - lengths)[lengths > 0]
        starts = cut_points(buffer, begins, self.whole) if self.cuttable else begins
        codes, words, hashes = factorize(buffer, starts, np.append(starts[1:], len(buffer)))
        bounds = np.searchsorted(starts, np.append(0, np.cumsum(lengths)))
        return codes, words, hashes, np.diff(bounds)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Numbers of distinct pieces in `ids`; those not known yet are encoded."""
        if len(self.known) > REMEMBERED:
            self.age()
        found = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing) and self.older:
            known, ids, begins, counts = self.older
            held = np.fromiter((known.get(words[i], -1) for i in missing.tolist()), np.int64, len(missing))
            kept, held = missing[held >= 0], held[held >= 0]
            flat, counts = gather(ids, begins[held], counts[held])
            found[kept] = self.learn([words[i] for i in kept.tolist()], flat, counts) + np.arange(len(kept))
            missing = np.flatnonzero(found < 0)
        if len(missing):
            fresh = [words[i] for i in missing.tolist()]
            made = self.encode_words(fresh)
            counts = np.fromiter(map(len, made), np.int64, len(made))
            flat = np.fromiter(chain.from_iterable(made), np.uint32, int(counts.sum()))
            found[missing] = self.learn(fresh, flat, counts) + np.arange(len(fresh))
        return found

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, number of ids of each text)."""
        flats, total = [], np.zeros(len(texts), np.int64)
        for numbers, parts in sections(texts):
            codes, words, _, per = self.split(parts)
            numbered = self.lookup(words)[codes]
            flat, counts = gather(self.ids, self.begins[numbered], self.counts[numbered])
            ends = np.append(0, np.cumsum(counts))
            edges = np.append(0, np.cumsum(per))
            np.add.at(total, numbers, ends[edges[1:]] - ends[edges[:-1]])
            flats.append(flat)
        return np.concatenate(flats) if flats else np.zeros(0, np.uint32), total


def gather(values: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` given by begin and count, one after another, and the counts."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(begins - (ends - counts), counts)], counts


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    return held_alone(Encoder, path)

import base64
import gzip
import hashlib
import random

import pytest

from candles.llm import warc


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows):
    first = {}
    for k, _, html in rows:
        if k is not None:
            d = digest((html or "").encode())
            first[d] = min(first.get(d, k), k)
    out = []
    for k, u, html in rows:
        data = (html or "").encode()
        d = digest(data)
        again = k is not None and first[d] < k
        out.append((k, u and " ".join(u.splitlines()), None if again else data, len(data), d, "revisit" if again else "response", first[d] if again else None))
    return sorted(out, key=repr)


def rows(n):
    rng = random.Random(8)
    made = [(i, f"http://h/{i}", rng.choice(["same", "", None, "é" * 400, f"page {i} \r\n\r\n WARC/1.1 \x00 {rng.random()}"])) for i in range(n)]
    return made + [(None, None, "same"), (None, "u\nv", "x"), (5, "twice", "same"), (5, "twice", "same"), (-3, "u", "é" * 400)]


@pytest.mark.parametrize("size", [1 << 20, 2000, 1])
def test_round_trip(spark, tmp_path, size):
    made = rows(300)
    pages = spark.createDataFrame(made, "page_id long, url string, html string").repartition(6)
    warc.write_warc(pages, str(tmp_path / "a"), file_bytes=size)
    got = [(*r[:2], r[2] and bytes(r[2]) if r[2] is None or len(r[2]) else b"", *r[3:]) for r in map(tuple, warc.read_warc(spark, str(tmp_path / "a")).collect())]
    assert sorted(got, key=repr) == expected(made)
    files = sorted(p for p in (tmp_path / "a").iterdir() if p.name.endswith(".warc.gz"))
    keys = []
    for p in files:
        assert size == 1 or p.stat().st_size < max(2 * size, 2000)
        text = gzip.decompress(p.read_bytes())
        keys += [int(line.split(b": ")[1]) for line in text.split(b"\r\n") if line.startswith(b"X-Page-ID")]
    assert keys == sorted(keys)


def test_same_files_again(spark, tmp_path):
    pages = spark.createDataFrame(rows(80), "page_id long, url string, html string")
    for name in ("a", "b"):
        warc.write_warc(pages.repartition(3 if name == "a" else 7), str(tmp_path / name), file_bytes=3000)
    read = lambda n: [gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / n).iterdir()) if p.name.endswith("gz")]
    assert b"".join(read("a")) == b"".join(read("b"))
    with pytest.raises(OSError):
        warc.write_warc(pages, str(tmp_path / "a"))


def test_large_record_and_empty_table(spark, tmp_path):
    big = "0123456789abcdef" * (18 << 16)
    pages = spark.createDataFrame([(1, "u", big), (2, "u", "x")], "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "big"))
    got = sorted((r.page_id, r.payload_bytes) for r in warc.read_warc(spark, str(tmp_path / "big")).collect())
    assert got == [(1, len(big)), (2, 1)]
    warc.write_warc(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).collect() == []


def test_damage_is_noticed():
    raw = warc.make_record(1, "u", b"body", digest(b"body"), None)
    assert warc.parse_record(raw)[1] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"body", b"bodx"))

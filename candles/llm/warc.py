"""WARC archives: a deterministic sharded writer and a reader.

Records are sorted by range of the key and packed into files by their compressed size. Every record
is a gzip member of its own with newly made headers and digests. Files are written to a temporary
folder by Spark's own committer, named by their place in the order, listed in a manifest, and the
folder is moved to its place last, so that a reader sees all of an archive or none of it.

Spark has no writer for binary files, but its text writer puts out a value's bytes as they are and
then a separator. The last byte of a gzip member is the high byte of its length, zero for members
under 16 MB, so a record goes out without that byte and the separator is the zero byte. A larger
record ends with an empty member, which a gzip reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candles.llm.common import arrow_map, pa_schema, record, session_of, utf8

FILE_BYTES, LEVEL = 32 << 20, 6
#: Payload bytes that a reader passes on at once, whole records, and file bytes that it unpacks at once.
LARGE, FED = 1 << 24, 1 << 14
FIXED_DATE = "1970-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    member = packer.compress(data) + packer.flush()
    if member[-1]:
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        member += packer.flush()
    return member


def record_id(key: int | str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{digest}')}>"


def make_record(key, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record: a response with its payload, or a revisit (refers_to is not None) with the HTTP
    head alone. Unknown values have no header."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(key, digest)),
              ("WARC-Date", FIXED_DATE), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
              ("X-Payload-Length", len(payload))]
    if key is not None:
        fields.append(("X-Page-ID", key))
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.splitlines())))
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", refers_to),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields.append(("Content-Length", len(block)))
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return b"WARC/1.1\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def write_warc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html",
    file_bytes: int = FILE_BYTES, smallest: int = 0,
) -> None:
    """Write the pages as `path`/00000-00000.warc.gz ... and `path`/manifest.json.

    Of pages with equal payloads (null: empty) of at least `smallest` bytes, the one with the
    smallest key is the response and the others revisit it; a page without a key is always a
    response. Of repeated rows with the smallest key all are responses. Keys are longs; equal keys
    are ordered by digest. No pages give a manifest without files. A very long payload is one record, held
    by the task that writes it; other columns are not looked at.
    """
    spark = session_of(pages)
    body = utf8(F.col(payload))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), body.alias("body"), F.sha1(body).alias("sha"))
    named = rows.where(F.col("key").isNotNull() & (F.octet_length("body") >= smallest)).select("key", "sha")
    firsts = named.groupBy("sha").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("last > first")
    again = named.join(firsts, "sha").where("key > first").select("key", "sha", "first").distinct()
    # A page's row and the note that it is a revisit meet by the sort, so payloads move once.
    noted = again.select("key", "sha", "first", F.lit(None).cast("binary").alias("body"), F.lit(None).cast("string").alias("url"))
    both = rows.select("key", "sha", F.lit(None).cast("long").alias("first"), "body", "url").unionByName(noted)
    both = both.repartitionByRange("key", "sha").sortWithinPartitions("key", "sha", F.col("first").isNull(), "url")
    schema = "shard int, file int, nth long, bytes long, member binary"
    types = pa_schema(spark, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        file, filled, nth, note = 0, 0, 0, None
        for batch in batches:
            made: dict[str, list] = {name: [] for name in types.names}
            held = 0
            for k, sha, first, body, link in zip(*(c.to_pylist() for c in batch.columns)):
                if first is not None:
                    note = (k, sha, first)
                    continue
                refers_to = note[2] if note and note[:2] == (k, sha) else None
                member = _member(make_record(k, link, body, base32(bytes.fromhex(sha)), refers_to))
                if filled and filled + len(member) > file_bytes:
                    file, filled = file + 1, 0
                filled += len(member)
                for name, value in zip(types.names, (shard, file, nth, len(member), member[:-1])):
                    made[name].append(value)
                nth += 1
                held += len(member)
                if held > file_bytes:
                    yield record(made, types)
                    made, held = {name: [] for name in types.names}, 0
            if made["nth"]:
                yield record(made, types)

    temporary = f"{path.rstrip('/')}.writing-{uuid.uuid4().hex}"
    members = both.mapInArrow(run, schema)
    named_files = members.select(
        F.concat(F.lpad(F.col("shard").cast("string"), 5, "0"), F.lit("-"), F.lpad(F.col("file").cast("string"), 5, "0")).alias("file"),
        "nth", F.col("member").cast("string").alias("value"))
    named_files.sortWithinPartitions("file", "nth").select("file", "value").write.partitionBy("file").option(
        "lineSep", "\x00").text(temporary)
    _commit(spark, temporary, path)


def _commit(spark: SparkSession, temporary: str, path: str) -> None:
    """Name the files, write the manifest, move the folder; names and sizes only pass the driver."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(temporary)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = []
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith("file="):
            fs.delete(status.getPath(), True)
            continue
        parts = [p for p in fs.listStatus(status.getPath()) if p.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"{len(parts)} parts of {name}")
        final = f"{name[len('file='):]}.warc.gz"
        if not fs.rename(parts[0].getPath(), jvm.org.apache.hadoop.fs.Path(folder, final)):
            raise OSError(f"cannot name {final}")
        files.append({"file": final, "bytes": parts[0].getLen()})
        fs.delete(status.getPath(), True)
    manifest = json.dumps({"files": sorted(files, key=lambda f: f["file"])}, indent=1)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(folder, "manifest.json"), False)
    out.write(manifest.encode())
    out.close()
    if fs.exists(jvm.org.apache.hadoop.fs.Path(path)) or not fs.rename(folder, jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"{path} exists or cannot be written")


def _records(data: bytes) -> Iterator[bytes]:
    """The WARC records of a file; a gzip member that is empty is skipped."""
    at, view = 0, memoryview(data)
    while at < len(data):
        packer, parts = zlib.decompressobj(31), []
        while not packer.eof:
            piece = view[at:at + FED]
            if not piece:
                raise ValueError("a gzip member is cut short")
            parts.append(packer.decompress(piece))
            at += len(piece)
        at -= len(packer.unused_data)
        if out := b"".join(parts):
            yield out


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-cased name, payload); digests and lengths are checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    if fields["warc-block-digest"] != f"sha1:{base32(hashlib.sha1(block).digest())}":
        raise ValueError("a block's digest is wrong")
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{base32(hashlib.sha1(payload).digest())}":
        raise ValueError("a payload's digest is wrong")
    return fields, payload


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of every record
    of an archive's files. A revisit has a null payload, but the length of the one it stands for.
    A file is read by one task, so the writer's `file_bytes` bounds what a task holds."""
    schema = ("page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long")
    session_of(spark.range(0))
    types = pa_schema(spark, schema)
    names = json.loads("\n".join(r.value for r in spark.read.text(f"{path}/manifest.json").collect()))["files"]
    if not names:
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").load([f"{path}/{f['file']}" for f in names]).select("content")

    def run(columns: dict) -> Iterable[dict]:
        made, held = {name: [] for name in types.names}, 0
        for data in columns["content"]:
            for raw in _records(data.as_buffer().to_pybytes()):
                fields, payload = parse_record(raw)
                page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                values = (
                    page and int(page), fields.get("warc-target-uri"),
                    payload if fields["warc-type"] == "response" else None, int(fields["x-payload-length"]),
                    fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"], refers and int(refers))
                for name, value in zip(types.names, values):
                    made[name].append(value)
                held += len(payload)
                if held > LARGE:
                    yield made
                    made, held = {name: [] for name in types.names}, 0
        yield made

    return arrow_map(files, run, schema)

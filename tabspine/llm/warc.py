"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames. Each frame holds some whole records; a skippable frame at the end holds the seek
table, with the compressed and plain size of every frame, so any reader can jump. An index table maps each record to its
bundle, frame, and place within the frame. Payloads that occur again are written as revisits of the first record.

Tasks write bundles under names of their own and return index rows. Spark's commit of the index decides which bundles count: what
a lost or repeated task left behind is in no index row and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspine.sources.scratch import materialize

#: Format of the seek table: magic of a skippable frame, magic of its footer.
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1

#: Names up to which the list of bundles is sent to those that read them, at about 50 bytes each.
FEW_BUNDLES = 100_000

INDEX = (
    "bundle string, frame long, frame_start long, frame_bytes long, record_start long, record_bytes long, record_id string, "
    "key long, record_type string"
)


@dataclass(frozen=True)
class Settings:
    """Plain bytes of a frame, plain bytes of a bundle, compression level, smallest payload that can be a revisit, and the date in the records."""

    frame_bytes: int = 1 << 20
    bundle_bytes: int = 48 << 20
    level: int = 3
    least_revisit: int = 0
    date: str = "2024-01-01T00:00:00Z"


def record_id(key: int | None, payload: bytes, n: int) -> str:
    """An identifier that follows from what is written, so that a repeated task writes the same."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}/{n}/{hashlib.sha1(payload).hexdigest()}')}>"


def record(id: str, key: int | None, url: str | None, payload: bytes, digest: str, first: int | None, s: Settings) -> bytes:
    """One record; with ``first``, the key of the response that has the payload, a revisit."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if first is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if first is not None else 'response'}", f"WARC-Record-ID: {id}", f"WARC-Date: {s.date}",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"), f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if key is not None:
        head.append(f"WARC-Source-Key: {key}")
    if first is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To-Source-Key: {first}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Header fields by lower-case name, HTTP head and payload of each record in ``data``."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record here")
        fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}
        start = end + 4
        stop = start + int(fields["content-length"])
        http, _, payload = data[start:stop].partition(b"\r\n\r\n")
        yield fields, http, payload
        at = stop + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The closing skippable frame for frames of ``(compressed, plain)`` bytes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, _SEEKABLE)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def frames(bundle: memoryview) -> list[tuple[int, int]]:
    """Start and compressed size of each frame, read from the seek table."""
    n, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != _SEEKABLE:
        raise ValueError("no seek table")
    sizes = np.frombuffer(bundle[len(bundle) - 9 - 8 * n : len(bundle) - 9], "<u4").reshape(n, 2)[:, 0].astype(np.int64)
    return list(zip((np.cumsum(sizes) - sizes).tolist(), sizes.tolist()))


class _Bundle:
    """A bundle under construction: closed frames, the open frame, and the index rows of its records."""

    def __init__(self, name: str, s: Settings):
        self.name, self.s, self.out, self.sizes, self.rows = name, s, bytearray(), [], []
        self.open, self.plain, self.waiting = bytearray(), 0, []

    def add(self, data: bytes, *row) -> None:
        if self.open and len(self.open) + len(data) > self.s.frame_bytes:
            self.close_frame()
        self.waiting.append((len(self.open), len(data), *row))
        self.open += data
        self.plain += len(data)

    def close_frame(self) -> None:
        if self.open:
            packed = zstandard.ZstdCompressor(level=self.s.level).compress(bytes(self.open))
            at = (len(self.sizes), len(self.out), len(packed))
            self.rows += [(self.name, *at, *row) for row in self.waiting]
            self.sizes.append((len(packed), len(self.open)))
            self.out += packed
            self.open, self.waiting = bytearray(), []

    def bytes(self) -> bytes:
        self.close_frame()
        return bytes(self.out) + seek_table(self.sizes)


def mark_revisits(pages: DataFrame, key: str, payload: str, s: Settings) -> DataFrame:
    """Adds ``digest`` and ``first``: for payloads that occur before, the smallest key with that payload.

    Only digests and keys are aggregated, before the shuffle already; payloads that occur once need no partner in the join.
    """
    digest = F.sha1(F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary"))
    rows = pages.withColumn("digest", digest)
    several = pages.select(digest.alias("digest"), F.col(key).cast("long").alias("first")).groupBy("digest").agg(
        F.min("first").alias("first"), F.count("*").alias("n")
    )
    several = several.where("n > 1").drop("n")
    rows = rows.join(several, "digest", "left")
    size = F.octet_length(F.coalesce(F.col(payload).cast("string"), F.lit("")))
    again = (F.col(key).cast("long") != F.col("first")) | (F.col(key).isNull() & F.col("first").isNotNull())
    return rows.withColumn("first", F.when(again & (size >= s.least_revisit), F.col("first")))


def write(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", payload: str = "html", settings: Settings | None = None) -> None:
    """Write a record per row to bundles in ``root/bundles`` and the index to ``root/index``.

    Of equal payloads that of the smallest key is a response, the others are revisits. Null payloads are empty. Rows that repeat
    both key and payload are each a response; a null key is never the first of its payload, unless all are null. An empty
    table writes an empty index. ``root`` must be a store that pyarrow can write: a shared folder, HDFS, S3 or GCS.
    """
    s = settings or Settings()
    rows = mark_revisits(pages, key, payload, s).select(
        F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"), "first",
    )
    folder = f"{root}/bundles"

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pyarrow.fs.FileSystem.from_uri(folder)
        run, made, open_bundle, n = uuid.uuid4().hex, 0, None, 0

        def close(done: _Bundle) -> pa.RecordBatch:
            store.create_dir(path, recursive=True)
            data = done.bytes()
            with store.open_output_stream(f"{path}/{done.name}", compression=None) as out:
                out.write(data)
            return pa.RecordBatch.from_pylist([dict(zip(_NAMES, row)) for row in done.rows], _INDEX_SCHEMA)

        for batch in batches:
            for i in range(batch.num_rows):
                k, u, data, first = (batch.column(c)[i].as_py() for c in range(4))
                if open_bundle is None:
                    open_bundle, made = _Bundle(f"{run}-{made:06d}.warc.zst", s), made + 1
                id = record_id(k, data, n)
                digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
                kind = "response" if first is None else "revisit"
                open_bundle.add(record(id, k, u, data, digest, first, s), id, k, kind)
                n += 1
                if open_bundle.plain >= s.bundle_bytes:
                    yield close(open_bundle)
                    open_bundle = None
        if open_bundle is not None:
            yield close(open_bundle)

    rows.mapInArrow(bundle, INDEX).write.parquet(f"{root}/index")


_INDEX_SCHEMA = pa.schema([
    ("bundle", pa.string()), ("frame", pa.int64()), ("frame_start", pa.int64()), ("frame_bytes", pa.int64()),
    ("record_start", pa.int64()), ("record_bytes", pa.int64()), ("record_id", pa.string()), ("key", pa.int64()),
    ("record_type", pa.string()),
])
_NAMES = _INDEX_SCHEMA.names
RECORDS = (
    "record_id string, key long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def _rows(data: bytes) -> list[dict]:
    found = []
    for fields, http, payload in parse(data):
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        revisit = fields["warc-type"] == "revisit"
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"damaged record {fields['warc-record-id']}")
        key, first = fields.get("warc-source-key"), fields.get("warc-refers-to-source-key")
        found.append({
            "record_id": fields["warc-record-id"], "key": int(key) if key else None, "url": fields["warc-target-uri"],
            "record_type": fields["warc-type"], "payload_bytes": size, "payload_digest": digest,
            "refers_to": int(first) if first else None, "payload": None if revisit else payload,
        })
    return found


_RECORD_SCHEMA = pa.schema([
    ("record_id", pa.string()), ("key", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{root}/index")


def _bundles(spark: SparkSession, root: str, named: DataFrame) -> DataFrame:
    """``(bundle, content)`` of the bundles that ``named`` lists, read by Spark from any store; none where none was written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/bundles")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "bundle string, content binary")
    files = spark.read.format("binaryFile").load(f"{root}/bundles")
    name = F.element_at(F.split("path", "/"), -1)
    listed = materialize(named.select("bundle").distinct(), "bundles")
    listed = F.broadcast(listed) if listed.count() <= FEW_BUNDLES else listed
    return files.select(name.alias("bundle"), "content").join(listed, "bundle", "left_semi")


def read(spark: SparkSession, root: str, payloads: bool = True) -> DataFrame:
    """All records of all indexed bundles. Payload digests are checked; a revisit's payload is null, its size that of the response."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            for content in batch.column(0):
                data = memoryview(content.as_buffer())
                for start, size in frames(data):
                    rows = _rows(plain.decompress(data[start : start + size]))
                    if not payloads:
                        rows = [{**r, "payload": None} for r in rows]
                    yield pa.RecordBatch.from_pylist(rows, _RECORD_SCHEMA)

    return _bundles(spark, root, index(spark, root)).select("content").mapInArrow(unpack, RECORDS)


def look_up(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """The records whose ``record_id`` is in ``ids``: only their frames are unpacked, and cut at their places."""
    wanted = index(spark, root).join(ids.select("record_id").distinct(), "record_id", "left_semi")
    rows = _bundles(spark, root, wanted).join(wanted, "bundle").select(
        F.expr("substring(content, cast(frame_start as int) + 1, cast(frame_bytes as int))").alias("packed"), "record_start", "record_bytes"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            for packed, start, size in zip(*batch.columns):
                data = plain.decompress(packed.as_buffer())
                yield pa.RecordBatch.from_pylist(_rows(data[start.as_py() : start.as_py() + size.as_py()]), _RECORD_SCHEMA)

    return rows.mapInArrow(cut, RECORDS)

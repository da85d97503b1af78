"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding whole WARC/1.1 records, then a
skippable frame with the record index, then a skippable frame with the seek table of the public
seekable format (a compressed and a decompressed size for each frame, the number of frames, a
descriptor byte and the magic number). The index maps each record to its frame and to its offset
and length inside that frame, so one record is read by decoding one frame.

Bundles are written by Spark's own text sink, a row for each file: its committer makes them appear
whole or not at all if executors are lost, and they go to whatever file system the path names. The
sink ends every row with a separator; the separator is set to the seek table's magic number, the
last four bytes that a bundle has anyway. They are read with the binary file source.

Payloads that are equal (by length and SHA-256) and of at least ``min_revisit`` bytes are stored
once: the record with the largest id is the response, the others are revisits that refer to it.
Which one it is follows from an aggregation with map-side combine and a join that adaptive
execution can split, so a page that a third of all rows repeat stays within bounds.

Defined results: a null payload is empty. Rows that share the largest id and the payload are all
responses; a null id is smaller than any other and is written as no id at all; if all ids of equal
payloads are null, all are responses. Null URLs have no target header. Empty tables give an empty
folder of bundles.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.session import shared_path

MIN_REVISIT = 1000
#: Bytes of records from which a frame is closed.
FRAME_BYTES = 1 << 20
#: Compressed bytes from which a bundle is closed; a bundle is held in memory.
BUNDLE_BYTES = 16 << 20
#: Pages and bundles that pass between the JVM and Python at a time.
_ROWS = 64
#: Of the seekable format (fixed values).
_SEEK_FRAME, _SEEK_MAGIC, _INDEX_FRAME = 0x184D2A5E, 0x8F92EAB1, 0x184D2A50
_DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_INDEX = np.dtype([("has_id", "u1"), ("id", "<i8"), ("frame", "<u4"), ("offset", "<u4"), ("length", "<u4")])


def _uri(url: str) -> str:
    """A URL that cannot break a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, revisit: bool, date: str = _DATE) -> bytes:
    """One WARC record. ``size`` and ``digest`` are of the full payload, which a revisit leaves out."""
    block = _HTTP if revisit else _HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        *([f"WARC-Target-URI: {_uri(url)}"] if url is not None else []),
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        *([f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"] if revisit else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The headers of one record, by lower-case name, and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a WARC/1.1 record: {first[:40]!r}")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}
    block = rest[: int(headers["content-length"])]
    return headers | {"payload": block.partition(b"\r\n\r\n")[2]}


class Bundle:
    """A bundle that is being written."""

    def __init__(self, frame_bytes: int, level: int):
        self.frame_bytes, self.packer = frame_bytes, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[bytes] = []
        self.sizes: list[int] = []
        self.index: list[tuple] = []
        self.open: list[bytes] = []
        self.fill = self.bytes = 0

    def add(self, page_id: int | None, data: bytes) -> None:
        self.index.append((page_id is not None, page_id or 0, len(self.frames), self.fill, len(data)))
        self.open.append(data)
        self.fill += len(data)
        if self.fill >= self.frame_bytes:
            self.close()

    def close(self) -> None:
        if self.open:
            self.frames.append(self.packer.compress(b"".join(self.open)))
            self.sizes.append(self.fill)
            self.bytes += len(self.frames[-1])
            self.open, self.fill = [], 0

    def finish(self) -> bytes:
        self.close()
        index = self.packer.compress(np.array(self.index, _INDEX).tobytes())
        held = struct.pack("<II", _INDEX_FRAME, len(index)) + index
        table = b"".join(struct.pack("<II", len(f), n) for f, n in zip([*self.frames, held], [*self.sizes, 0], strict=True))
        table += struct.pack("<IBI", len(self.frames) + 1, 0, _SEEK_MAGIC)
        return b"".join([*self.frames, held, struct.pack("<II", _SEEK_FRAME, len(table)), table])


class Reader:
    """Random access to a bundle's records."""

    def __init__(self, data: bytes):
        self.data, self.unpacker = data, zstandard.ZstdDecompressor()
        count, _, magic = struct.unpack("<IBI", data[-9:])
        if magic != _SEEK_MAGIC:
            raise ValueError("no seek table")
        entries = np.frombuffer(data, "<u4", 2 * count, len(data) - 9 - 8 * count).reshape(count, 2).astype(np.int64)
        self.sizes, self.ends = entries[:, 1], np.cumsum(entries[:, 0])
        self.starts = self.ends - entries[:, 0]
        kind, size = struct.unpack_from("<II", data, self.starts[-1])
        if kind != _INDEX_FRAME:
            raise ValueError("no record index")
        at = int(self.starts[-1]) + 8
        self.index = np.frombuffer(self.unpacker.decompress(data[at : at + size]), _INDEX)
        self._frame: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self._frame[0] != k:
            self._frame = (k, self.unpacker.decompress(self.data[self.starts[k] : self.ends[k]], int(self.sizes[k])))
        return self._frame[1]

    def read(self, k: int) -> bytes:
        """The record at place ``k`` of the index."""
        row = self.index[k]
        start = int(row["offset"])
        return self.frame(int(row["frame"]))[start : start + int(row["length"])]


def plan(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Rows (id, url, payload, size, digest, response, revisit): what is written for each page; a revisit has no payload."""
    body = F.encode(F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(f"`{page_id}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload")).withColumn("same", F.sha2("payload", 256))
    large = rows.where(F.col("size") >= min_revisit)
    shared = large.groupBy("same").agg(F.max("id").alias("response"), F.count("*").alias("n")).where("n > 1").select(F.col("same").alias("_same"), "response")
    joined = rows.join(shared.hint("shuffle_hash"), (F.col("same") == F.col("_same")) & (F.col("size") >= min_revisit), "left")
    joined = joined.withColumn("revisit", F.col("response").isNotNull() & ~F.col("id").eqNullSafe(F.col("response")))
    return joined.select("id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "size", "digest", F.when(F.col("revisit"), F.col("response")).alias("response"), "revisit")


def write(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    min_revisit: int = MIN_REVISIT, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = 3, date: str = _DATE,
) -> None:
    """Write a record for each page to bundles in the folder ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle(frame_bytes, level)

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([bundle.finish()[:-4]], pa.binary())], names=["bundle"])

        for batch in batches:
            for row in range(batch.num_rows):
                own = {n: batch.column(i)[row].as_py() for i, n in enumerate(batch.schema.names)}
                bundle.add(own["id"], record(own["id"], own["url"], own["payload"] or b"", own["size"], own["digest"], own["response"], own["revisit"], date))
                if bundle.bytes >= bundle_bytes:
                    yield made()
                    bundle = Bundle(frame_bytes, level)
        if bundle.index:
            yield made()

    files = plan(pages, page_id, url, payload, min_revisit).mapInArrow(run, "bundle binary")
    magic = struct.pack("<I", _SEEK_MAGIC).decode("latin-1")
    # a cast keeps the bytes as they are, and the sink writes a string's bytes
    raw = files.select(F.col("bundle").cast("string").alias("value"))
    raw.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", magic).text(path)


def bundles(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, content): the bundles in a folder."""
    return spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path).where("length > 0").select("path", "content")


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page_id, path, frame, frame_start, offset, length): where each record lies."""
    inner = "page_id long, path string, frame long, frame_start long, offset long, length long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                reader = Reader(content.as_py())
                index = reader.index
                ids = pa.array(index["id"].astype(np.int64), mask=index["has_id"] == 0)
                numbers = [pa.array(index[n].astype(np.int64)) for n in ("frame", "offset", "length")]
                starts = pa.array(reader.starts[index["frame"].astype(np.int64)])
                yield pa.RecordBatch.from_arrays([ids, pa.array([file.as_py()] * len(index)), numbers[0], starts, *numbers[1:]], names=["page_id", "path", "frame", "frame_start", "offset", "length"])

    return bundles(spark, path).mapInArrow(run, inner)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Rows (page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload): all records, through their index entries.

    Without ``payloads`` they are checked but not returned.
    A response's length and digest are taken from the payload that is stored; a revisit's are the ones it states.
    """
    inner = T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType())]
        + [T.StructField(n, T.StringType()) for n in ("payload_digest", "record_type")]
        + [T.StructField("refers_to", T.LongType()), T.StructField("payload", T.BinaryType())]
    )

    def numbered(value: str | None) -> int | None:
        return int(value[len("<urn:page:") : -1]) if value and value != "<urn:page:>" else None

    def rows(reader: Reader) -> Iterator[tuple]:
        for k in range(len(reader.index)):
            own = parse(reader.read(k))
            kind, body = own["warc-type"], own["payload"]
            size, digest = len(body), hashlib.sha1(body).hexdigest()
            if kind == "revisit":
                size, digest, body = int(own["x-payload-length"]), own["warc-payload-digest"].removeprefix("sha1:"), None
            elif (size, digest) != (int(own["x-payload-length"]), own["warc-payload-digest"].removeprefix("sha1:")):
                raise ValueError(f"record {own['warc-record-id']} does not hold its payload")
            yield numbered(own["warc-record-id"]), own.get("warc-target-uri"), size, digest, kind, numbered(own.get("warc-refers-to")), body if payloads else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column(1):
                held: list[tuple] = []
                for row in rows(Reader(content.as_py())):
                    held.append(row)
                    if len(held) == _ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=inner.names)
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=inner.names)

    return bundles(spark, path).mapInArrow(run, inner)


def archive(pages: DataFrame, payloads: bool = True, **options) -> tuple[str, DataFrame]:
    """Write the pages to a fresh folder in the shared one; its path and the records read back."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    write(pages, path, **options)
    return path, read(spark, path, payloads)

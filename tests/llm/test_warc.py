import hashlib
import random
import struct

import zstandard
from pyspark.sql import functions as F

from sieveline.llm import warc


def sample():
    rng = random.Random(11)
    bodies = ["é" * 499, "é" * 500, "x" * 999, "y" * 1000, "\r\n\r\nWARC/1.1\r\n" * 100, "", None, "big " * 100_000]
    pages = [(i, f"http://h{i}.example/\r\n x?q={i}", rng.choice(bodies)) for i in range(50)]
    return pages + [(7, "http://again/", "y" * 1000), (60, None, "z" * 2000), (60, "u", "z" * 2000), (None, "u", "z" * 2000), (None, "n", "only null " * 200), (None, "n", "only null " * 200), (61, "u", "".join(chr(rng.randint(1, 0x2FF)) for _ in range(5000)))]


def brute(pages):
    out = []
    for pid, _, html in pages:
        raw = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == raw and p is not None]
        top = max(same, default=None)
        revisit = len(raw) >= 1000 and top is not None and pid != top
        out.append((str(pid), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def rows(df):
    return sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_round_trip(spark):
    pages = sample()
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3).select("*", F.lit(1).alias("payload"), F.lit("x").alias("same"), F.lit(1).alias("size"))
    path, back = warc.archive(df, frame_bytes=3000, bundle_bytes=300)
    assert rows(back) == brute(pages)
    stored = [bytes(r.payload).decode() for r in back.where("record_type = 'response'").collect()]
    want = {h or "" for *_, h in pages}
    assert set(stored) == want and stored.count("y" * 1000) <= 2
    files = [bytes(r.content) for r in warc.bundles(spark, path).collect()]
    assert len(files) > 3


def test_index_finds_each_record_in_its_frame(spark):
    df = spark.createDataFrame(sample(), "page_id long, url string, html string").repartition(2)
    path, _ = warc.archive(df, frame_bytes=5000)
    files = {r.path: bytes(r.content) for r in warc.bundles(spark, path).collect()}
    for r in warc.record_index(spark, path).collect():
        frame = zstandard.ZstdDecompressor().decompressobj().decompress(files[r.path][r.frame_start :])
        own = warc.parse(frame[r.offset : r.offset + r.length])
        assert own["warc-record-id"] == f"<urn:page:{'' if r.page_id is None else r.page_id}>"
    for data in files.values():
        count, flags, magic = struct.unpack("<IBI", data[-9:])
        sizes = [struct.unpack_from("<II", data, len(data) - 9 - 8 * (count - k)) for k in range(count)]
        assert magic == 0x8F92EAB1 and not flags
        assert sum(c for c, _ in sizes) + 8 + 8 * count + 9 == len(data)  # the table is itself in a skippable frame
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert len(whole) == sum(d for _, d in sizes)


def test_empty_table(spark):
    _, back = warc.archive(spark.createDataFrame([], "page_id long, url string, html string"))
    assert back.collect() == []

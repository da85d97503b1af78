"""Line-level deduplication over the whole corpus.

Texts are split at \\n. A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends, A-Z
lower-cased; keys of fewer than ``min_chars`` code points never count. Keys are exploded once
per document as 128-bit hashes, distinct documents are counted per hash (with map-side
combine, so that a line that every document has costs a row per task), and keys found in at
least ``min_docs`` documents lose all their lines except in the largest document id that holds
them. The lines to drop go back to their documents by id and a hash of the text, so that rows that
share an id (or have none) get their own lines only, and the rest is reassembled in its order.

Defined results: a null or empty text is one empty line. Whether a line is dropped depends on
its key and its document's id alone, so rows that share an id are one document and are treated
alike; a null id counts as no document, and its lines of widespread keys go. Other columns pass
through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.batches import forget, slices
from sieveline.session import materialize

MIN_CHARS = 40
MIN_DOCS = 5
_WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def _key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or None if it is too short to count."""
    key = line.strip(_WHITE)
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())


def line_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """Rows (doc, part, high, low): the distinct keys of each document row, as two 64-bit halves; ``part`` is the text's hash."""
    inner = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), *(T.StructField(n, T.LongType()) for n in ("part", "high", "low"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for part in slices(whole, 0):
                row, high, low = [], [], []
                for k, value in enumerate(part.column(0).to_pylist()):
                    found = {_key(x, min_chars) for x in value.encode().split(b"\n")} if value else set()
                    for key in found - {None}:
                        row.append(k)
                        high.append(int.from_bytes(key[:8], "big", signed=True))
                        low.append(int.from_bytes(key[8:], "big", signed=True))
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(1).take(at), part.column(2).take(at), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=inner.names)

    body = F.col(f"`{text}`").cast("string")
    return docs.select(body.alias("_t"), F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(body).alias("part")).mapInArrow(run, inner)


def dropped_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int, min_docs: int) -> DataFrame:
    """Rows (doc, part, keys): for each document id and text, the keys whose lines it loses.

    Texts of one id that share a hash share their keys, which all are keys that the id loses.
    """
    keys = materialize(line_keys(docs, doc_id, text, min_chars), "line-keys")
    counted = keys.groupBy("high", "low").agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= min_docs)
    wide = materialize(counted.select(F.col("high").alias("h"), F.col("low").alias("l"), "keeper"), "wide-lines", compact=True)
    lost = keys.join(wide, (F.col("high") == F.col("h")) & (F.col("low") == F.col("l"))).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc", "part").agg(F.collect_set(F.struct("high", "low")).alias("keys"))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    counts: bool = True,
) -> DataFrame:
    """The documents, with the kept lines as their text, and with ``counts`` the columns _n_lines and _n_dropped.

    The counts replace columns of the same names.
    """
    columns = docs.columns
    lost = materialize(dropped_keys(docs, doc_id, text, min_chars, min_docs), "lost-lines", compact=True)
    tagged = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    place = {c: f"c{i}" for i, c in enumerate(columns)}
    tagged = tagged.withColumn(place[text], F.col(place[text]).cast("string"))
    own = F.col(place[doc_id]).eqNullSafe(F.col("doc")) & (F.xxhash64(place[text]) == F.col("part"))
    joined = tagged.join(lost.hint("shuffle_hash"), own, "left").drop("doc", "part")
    at = columns.index(text)
    inner = T.StructType([*tagged.schema.fields, T.StructField("_n_lines", T.LongType()), T.StructField("_n_dropped", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for whole in batches:
            for part in slices(whole, at):
                kept, lines, gone = [], [], []
                for value, keys in zip(part.column(at).to_pylist(), part.column(len(columns)).to_pylist(), strict=True):
                    own = value.encode().split(b"\n") if value else [b""]
                    lines.append(len(own))
                    if keys:
                        drop = {k["high"].to_bytes(8, "big", signed=True) + k["low"].to_bytes(8, "big", signed=True) for k in keys}
                        own = [x for x in own if _key(x, min_chars) not in drop]
                    gone.append(lines[-1] - len(own))
                    kept.append(b"\n".join(own).decode())
                arrays = [part.column(i) for i in range(len(columns))]
                arrays[at] = pa.array(kept, pa.string())
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(lines, pa.int64()), pa.array(gone, pa.int64())], names=inner.names)

    out = joined.mapInArrow(run, inner)
    made = ["_n_lines", "_n_dropped"] if counts else []
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns) if c not in made), *made)

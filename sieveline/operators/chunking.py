"""Splitting documents into chunks along their structure."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.operators.numbering import numbered

STRUCTURE = ("\n\n", "\n", ". ", " ")
PLAIN = ("\n\n", "\n", " ", "")


def split_text(text: str, size: int, overlap: int, separators: Sequence[str] = STRUCTURE) -> list[str]:
    """Chunks of at most ``size`` characters where the separators allow, up to ``overlap`` of them shared.

    The first separator that occurs cuts the text into pieces that start with it; pieces that are
    still too long are cut by the separators after it, and small ones are put together again. A
    piece that no separator cuts stays whole.
    """
    if overlap >= size:
        raise ValueError(f"overlap {overlap} is not below size {size}")
    out: list[str] = []

    def glue(pieces: list[str]) -> None:
        held: deque[str] = deque()
        total = 0
        for piece in pieces:
            if held and total + len(piece) > size:
                out.append("".join(held))
                while held and (total > overlap or total + len(piece) > size):
                    total -= len(held.popleft())
            held.append(piece)
            total += len(piece)
        if held:
            out.append("".join(held))

    def cut(part: str, level: int) -> None:
        at = next((i for i in range(level, len(separators)) if separators[i] in part), len(separators) - 1)
        sep = separators[at]
        head, *tail = list(part) if sep == "" else part.split(sep)
        pieces = [p for p in (head, *(sep + t for t in tail)) if p]
        small: list[str] = []
        for piece in pieces:
            if len(piece) < size:
                small.append(piece)
                continue
            glue(small)
            small = []
            if at + 1 < len(separators):
                cut(piece, at + 1)
            else:
                out.append(piece)
        glue(small)

    if text:
        cut(text, 0)
    return [c for c in (x.strip() for x in out) if c]


def chunk_texts(docs: DataFrame, text: str = "text", size: int = 1024, overlap: int = 128, separators: Sequence[str] = STRUCTURE) -> DataFrame:
    """The rows (without ``text``) with ``chunks``, the array of a document's chunks; null or blank text gives none."""
    others = [c for c in docs.columns if c != text]
    inner = T.StructType([*(docs.schema[c] for c in others), T.StructField("chunks", T.ArrayType(T.StringType()))])
    keep = tuple(separators)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = [split_text(x or "", size, overlap, keep) for x in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(others))), pa.array(chunks, pa.list_(pa.string()))], names=inner.names)

    return docs.select(*others, text).mapInArrow(run, inner)


def chunk(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str | None = "source", title: str | None = None, url: str | None = None,
    created: str | None = None, size: int = 1024, overlap: int = 128, least: int = 100, separators: Sequence[str] = STRUCTURE,
) -> DataFrame:
    """One row per chunk: chunk_id (SHA-256 of its text), chunk_text, chunk_index, article_id, source, source_url, created_time, metadata.

    Chunks shorter than ``least`` go before they are numbered. A missing source is ``Unknown``; a document without an id is an error.
    """
    pick = lambda c, kind="string": F.col(c).cast(kind) if c else F.lit(None).cast(kind)
    own = F.when(F.col(id_col).isNull(), F.raise_error(F.lit("a document has no id"))).otherwise(F.col(id_col).cast("string"))
    rows = docs.select(
        own.alias("article_id"), F.coalesce(pick(source), F.lit("Unknown")).alias("source"), F.coalesce(pick(url), F.lit("")).alias("source_url"),
        F.coalesce(pick(created), F.lit("")).alias("created_time"), F.coalesce(pick(title), F.lit("")).alias("title"), F.col(text).alias("text"),
    )
    kept = chunk_texts(rows, "text", size, overlap, separators).withColumn("chunks", F.filter("chunks", lambda c: F.length(c) >= least))
    each = kept.select("*", F.posexplode("chunks").alias("chunk_index", "chunk_text"))
    return each.select(
        F.sha2("chunk_text", 256).alias("chunk_id"), "chunk_text", "chunk_index", "article_id", "source", "source_url", "created_time",
        F.struct("title", F.length("chunk_text").alias("chunk_length"), F.size("chunks").alias("total_chunks")).alias("metadata"),
    )


def statistics(chunks: DataFrame) -> DataFrame:
    """One row of totals over chunks; zeros for none."""
    size = F.length("chunk_text")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return chunks.agg(
        F.count("*").alias("total_chunks"), zero(F.sum(size)).alias("total_chars"), zero(F.round(F.avg(size), 6)).alias("avg_chunk_size"),
        zero(F.min(size)).alias("min_chunk_size"), zero(F.max(size)).alias("max_chunk_size"), F.count_distinct("article_id").alias("unique_articles"),
    )


def batch_numbers(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """Rows with ``batch``, counted from 0 in each group, of ``size`` rows in order."""
    return numbered(rows, group, order, "_place").withColumn("batch", F.floor(F.col("_place") / size)).drop("_place")

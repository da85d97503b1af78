"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Texts are lower-cased (A-Z) and cut into words `[^\\x20\\x09-\\x0D]+`; every run of ``size`` words,
repeats included, is a shingle (a shorter text is one shingle as it is). A fingerprint bit is 1
if it is set in more than half of the shingles' XXH64 (seed 42). Two fingerprints link if they
differ in at most two bits: then some value lies within one bit of both. So every distinct
fingerprint emits itself and its 64 one-bit variants, the variants are shuffled, and those that
meet are linked to the smallest of them and verified.

At most 65 fingerprints can meet in a variant, all of them within two bits of each other, so a
star on the smallest loses no link, no pairs are enumerated, and no variant can be hot. Exact
copies collapse to one fingerprint before anything is emitted.

Defined results: null texts and texts without words have fingerprint zero and link like any
other; a component's id is the smallest document id in it, and null if all its ids are null.
Repeated rows stay, each with its component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm import shingles
from sieveline.llm import words as W
from sieveline.llm.batches import map_text, utf8
from sieveline.operators.components import connected_components
from sieveline.session import materialize

SIZE = 3
RADIUS = 2
SEED = 42
#: Shingles whose bits are counted at a time.
_STEP = 1 << 15


def _bits(h: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits (from the lowest) is set."""
    total = np.zeros(64, np.int64)
    for k in range(0, len(h), _STEP):
        part = np.ascontiguousarray(h[k : k + _STEP]).astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprints(column: pa.Array, size: int = SIZE) -> np.ndarray:
    """The fingerprint of each text, as unsigned 64-bit integers."""
    buf, offsets = utf8(column)
    buf = W.LOWER[buf]
    s, e, first = W.words(buf, offsets, W.SPACED)
    # the words again with one blank between them, so that a shingle is a slice
    lengths = e - s
    begin = np.concatenate([[0], np.cumsum(lengths + 1)])
    keep = np.repeat(s - begin[:-1], lengths + 1) + np.arange(begin[-1])
    last = begin[1:] - 1
    joined = buf[np.minimum(keep, max(len(buf) - 1, 0))] if len(buf) else buf
    joined[last] = 0x20
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    out = np.zeros(len(first) - 1, np.uint64)
    powers = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for row, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if a == b:
            continue
        n = max(b - a - size, 0) + 1
        tails = last[a + size - 1 : b] if b - a >= size else last[b - 1 : b]
        h = np.fromiter((digest(raw[x:y], SEED) for x, y in zip(begin[a : a + n].tolist(), tails.tolist(), strict=True)), np.uint64, n)
        out[row] = powers[2 * _bits(h) > n].sum(dtype=np.uint64)
    return out


def with_fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """Rows (doc, fp): each document row with its fingerprint as a long."""

    def fn(column: pa.Array) -> dict[str, pa.Array]:
        return {"fp": pa.array(fingerprints(column, size).view(np.int64))}

    renamed = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    return map_text(renamed, "text", fn, [T.StructField("fp", T.LongType())], ["doc"])


def links(distinct: DataFrame) -> DataFrame:
    """Rows (u, v), u < v: verified links of distinct fingerprints ``fp`` that connect all within RADIUS bits."""
    variants = distinct.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("variant"))
    met = variants.select("fp", F.expr("min(fp) over (partition by variant)").alias("u"))
    return met.where((F.col("fp") != F.col("u")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("u"))) <= RADIUS)).select("u", F.col("fp").alias("v")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) per document row; fingerprints in 16 lowercase hex digits."""
    marked = materialize(with_fingerprint(docs, doc_id, text, size), "fingerprints")
    own = materialize(marked.groupBy("fp").agg(F.min("doc").alias("least")), "distinct-fingerprints", compact=True)
    roots = connected_components(links(own.select("fp")))
    rooted = own.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # a table, so that both sides of the join with it are dealt afresh and a large component is split there
    least = materialize(rooted.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("component")), "least-documents", compact=True)
    named = rooted.join(least, F.col("root") == F.col("top")).select(F.col("fp").alias("own"), "component")
    out = marked.join(named, F.col("fp") == F.col("own"))
    return out.select(F.col("doc").alias(doc_id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def ball_links(marked: DataFrame) -> DataFrame:
    """Links (u, v) of the sets ``fp`` of rows (fp, ball) whose fingerprints ``ball`` are equal or within RADIUS bits, as many as connect them."""
    held = marked.select("ball", "fp").distinct()
    tops = materialize(held.groupBy("ball").agg(F.min("fp").alias("top")), "distinct-fingerprints", compact=True)
    same = held.join(tops.withColumnRenamed("ball", "_ball"), F.col("ball") == F.col("_ball")).where("fp <> top").select(F.col("top").alias("u"), F.col("fp").alias("v"))
    a, b = (tops.select(F.col("ball").alias(f"ball_{x}"), F.col("top").alias(x)) for x in "ab")
    met = links(tops.select(F.col("ball").alias("fp"))).join(a, F.col("u") == F.col("ball_a")).join(b, F.col("v") == F.col("ball_b"))
    return same.union(met.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")))


def similar_or_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, similarity: float = shingles.SIMILARITY) -> DataFrame:
    """One row (doc_id, component_id) per document row: components of both links, fingerprints (of SIZE words) within RADIUS bits and
    sets of runs of ``size`` words with a Jaccard similarity of ``similarity``.
    """
    balls = {"ball": lambda column: pa.array(fingerprints(column).view(np.int64))}
    marked = materialize(shingles.with_keys(docs, doc_id, text, size, similarity, balls), "shingle-keys")
    return shingles.labelled(marked, ball_links(marked).union(shingles.links(docs, marked, text, size, similarity)), doc_id)


def keep_least(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents whose id is the ``component_id`` that ``found`` gives them, with all their columns."""
    key = "_keep"
    while key in docs.columns:
        key += "_"
    kept = found.where(F.col(doc_id).eqNullSafe(F.col("component_id"))).select(F.col(doc_id).alias(key)).distinct()
    return docs.join(kept, F.col(f"`{doc_id}`").eqNullSafe(F.col(key)), "left_semi")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, similarity: float | None = None) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Components are those of fingerprints within RADIUS bits; if a ``similarity`` is given, texts whose sets of
    shingles have that Jaccard similarity are linked too (`shingles`: SimHash balls alone miss most of them).
    Rows that share that id are all kept; documents without an id are kept if no document of
    their component has one.
    """
    found = near_duplicates(docs, doc_id, text, size) if similarity is None else similar_or_near(docs, doc_id, text, size, similarity)
    return keep_least(docs, found, doc_id)

"""Near duplicates by the Jaccard similarity of word shingles, for similarities that SimHash balls cannot reach.

Words are those of `simhash`; a document's set holds the 64-bit hashes of its runs of ``size`` words
(a shorter text is one shingle as it is). Two sets link if their Jaccard similarity is ``similarity``
or more. At 0.8 the 64-bit fingerprints of a pair differ in some ten bits, so balls of two bits miss
it, and balls of ten would emit millions of variants: sets meet by MinHash instead.

* Equal sets collapse to one (64-bit hash of the set) before anything meets.
* Each set has SKETCH minima; the first of them make BANDS bucket keys. The number of minima a key
  follows from ``similarity``: a pair at that similarity meets nowhere with a chance of some 3 in 10^5
  (4 minima at 0.8), nearer pairs more rarely.
* First each bucket is a star on one of its sets, the one with the most copies, another one in each
  band among equals. Then only buckets whose sets are in different components are gone through, in
  blocks of at most BLOCK sets, so no bucket is gathered in a task and pairs of sets that are
  connected already are not formed. So every pair that meets is in one component or was compared.
* What meets must agree in so many minima that all but 3 in 10^5 of the pairs at ``similarity`` pass,
  and is then checked on the whole sets: no pair below ``similarity`` links.

Sets of one bucket that are not similar enough for each other and not in its main component are compared
with all of the bucket, a byte of each minimum at a time. m such sets of n cost m x n comparisons and n + m x n / BLOCK rows:
in line with the bucket while the stars leave a few, the square of their number if they leave most.

Defined results: null texts and texts without words have the empty set and are copies of each
other; a component's id is the smallest document id in it, and null if all its ids are null.
Repeated rows stay, each with its component.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm import words as W
from sieveline.llm.batches import map_text, nested, utf8
from sieveline.operators.components import connected_components
from sieveline.session import materialize

SIZE = 5
SIMILARITY = 0.8
BANDS = 20
SKETCH = 256
#: The chance that a pair at the similarity asked for meets in no bucket.
MISS = 3e-5
#: Sets of a bucket that one task compares with as many others.
BLOCK = 2048
#: Bytes of minima compared in one step.
_STEP = 4 << 20
_SALTS = W.mix(np.arange(1, 2 * SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32).reshape(2, -1)
_PAIR = "u long, v long"


def rows_of(similarity: float) -> int:
    """Minima in a bucket key, so that a pair at ``similarity`` misses all keys with a chance of about MISS."""
    if not 0 < similarity <= 1:
        raise ValueError(f"similarity is {similarity}, not above 0 and up to 1")
    most = SKETCH // BANDS
    return most if similarity == 1 else min(most, max(1, round(math.log(1 - MISS ** (1 / BANDS)) / math.log(similarity))))


def least_equal(similarity: float) -> int:
    """Equal minima that a pair at ``similarity`` has but for four standard deviations."""
    return math.floor(SKETCH * similarity - 4 * math.sqrt(SKETCH * similarity * (1 - similarity)))


def sets(column: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, as unsigned 64-bit integers."""
    buf, offsets = utf8(column)
    buf = W.LOWER[buf]
    s, e, first = W.words(buf, offsets, W.SPACED)
    h = W.hashes(buf, s, e)
    lengths = np.diff(first)
    g, at = W.windows(h, first, size)
    bounds = np.searchsorted(at, first)
    out = [np.unique(g[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    for k in range(1, size):
        rows = np.flatnonzero(lengths == k)
        if len(rows):
            g, at = W.windows(h, first, k)
            whole = W.mix(g[np.searchsorted(at, first[:-1][rows])] + np.uint64(k))
            for i, row in enumerate(rows):
                out[row] = whole[i : i + 1]
    return out


def fingerprints(own: list[np.ndarray]) -> pa.Array:
    """The hash of each set."""
    return pa.array(np.fromiter((xxhash.xxh3_64_intdigest(x.tobytes()) for x in own), np.uint64, len(own)).view(np.int64))


def buckets(own: list[np.ndarray], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """BANDS bucket keys of each set, and a byte of each of its minima; a set without shingles has zeros."""
    keys, sketches = np.zeros((len(own), BANDS), np.uint64), np.zeros((len(own), SKETCH), np.uint8)
    some = [k for k, x in enumerate(own) if len(x)]
    if not some:
        return keys, sketches
    flat = (np.concatenate([own[k] for k in some]) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(own[k]) for k in some])[:-1]])
    total = np.zeros(len(some), np.uint64)
    for i in range(SKETCH):
        least = np.minimum.reduceat((flat ^ _SALTS[0, i]) * (_SALTS[1, i] | np.uint32(1)), starts)
        sketches[some, i] = least >> np.uint32(8)
        band, place = divmod(i, rows)
        if band < BANDS:
            if not place:
                total = np.full(len(some), band + 1, np.uint64)
            total = W.mix((total ^ least.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(i))
            keys[some, band] = total
    return keys, sketches


def _plain(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"))


def with_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, similarity: float = SIMILARITY, also: dict[str, Callable[[pa.Array], pa.Array]] | None = None) -> DataFrame:
    """Rows (doc, fp, n, keys, sketch): each document row with its set's hash, size, bucket keys and minima; ``also`` makes more long columns of the texts."""
    rows = rows_of(similarity)
    also = also or {}

    def fn(column: pa.Array) -> dict[str, pa.Array]:
        own = sets(column, size)
        keys, sketches = buckets(own, rows)
        return {
            "fp": fingerprints(own),
            "n": pa.array([len(x) for x in own], pa.int64()),
            "keys": nested(list(keys.view(np.int64)), pa.int64()),
            "sketch": pa.array([x.tobytes() for x in sketches], pa.binary()),
            **{name: make(column) for name, make in also.items()},
        }

    fields = [T.StructField("fp", T.LongType()), T.StructField("n", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType()), *(T.StructField(name, T.LongType()) for name in also)]
    return map_text(_plain(docs, doc_id, text), "text", fn, fields, ["doc"])


def with_sets(docs: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """Rows (fp, shingles): each document row's set, its hashes as bytes, and the set's hash."""

    def fn(column: pa.Array) -> dict[str, pa.Array]:
        own = sets(column, size)
        return {"fp": fingerprints(own), "shingles": pa.array([x.tobytes() for x in own], pa.binary())}

    fields = [T.StructField("fp", T.LongType()), T.StructField("shingles", T.BinaryType())]
    return map_text(_plain(docs, text, text), "text", fn, fields, [])


def _joined(pairs: DataFrame, own: DataFrame, value: str) -> DataFrame:
    """Rows (u, v, a, b): the pairs with a column of either end."""
    a, b = (own.select(F.col("fp").alias(f"fp_{x}"), F.col(value).alias(x)) for x in "ab")
    return pairs.join(a, F.col("u") == F.col("fp_a")).join(b, F.col("v") == F.col("fp_b")).select("u", "v", "a", "b")


def _likely(pairs: DataFrame, own: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose minima do not rule ``similarity`` out."""
    least = least_equal(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                a, b = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH) for i in (2, 3))
                yield part.filter(pa.array(np.count_nonzero(a == b, axis=1) >= least)).select(["u", "v"])

    return _joined(pairs, own, "sketch").mapInArrow(run, _PAIR)


def similar(a: bytes, b: bytes, similarity: float) -> bool:
    """Whether two sets, given as the bytes of their sorted hashes, have the Jaccard similarity."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) - 1e-6:
        return False
    both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common >= similarity * (len(both) - common) - 1e-9


def _checked(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (u, v) whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [similar(a.as_py(), b.as_py(), similarity) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.filter(pa.array(good, pa.bool_())).select(["u", "v"])

    return _joined(pairs, held, "shingles").mapInArrow(run, _PAIR)


def _likely_in(table: pa.Table, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of likely pairs of a block: sets that are not in its most common component, with all that are in other ones."""
    least = least_equal(similarity)
    n, root = (table.column(c).to_numpy() for c in ("n", "root"))
    minima = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
    names, counts = np.unique(root, return_counts=True)
    others = np.flatnonzero(root != names[np.argmax(counts)])
    step = max(1, _STEP // (len(n) * SKETCH))
    for at in range(0, len(others), step):
        x = others[at : at + step]
        near = np.minimum(n[x][:, None], n) >= similarity * np.maximum(n[x][:, None], n) - 1e-6
        near &= root[x][:, None] != root
        rows = np.flatnonzero(near.any(axis=0))
        equal = np.count_nonzero(minima[x][:, None, :] == minima[rows], axis=2) >= least
        i, j = np.nonzero(equal & near[:, rows])
        yield x[i], rows[j]


def _hopeful(similarity: float):
    """The sets of a block that are in a likely pair."""

    def run(table: pa.Table) -> pa.Table:
        found = np.zeros(table.num_rows, bool)
        for a, b in _likely_in(table, similarity):
            found[a] = found[b] = True
        return table.filter(pa.array(found)).select(["key", "lo", "hi", "fp", "n", "root"])

    return run


def _forest(similarity: float):
    """Links of a block's similar sets, as many as connect them and no more."""

    def run(table: pa.Table) -> pa.Table:
        fp, whole = table.column("fp").to_pylist(), table.column("shingles")
        parent = {r: r for r in table.column("root").to_pylist()}
        tops, out = table.column("root").to_pylist(), []

        def find(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in _likely_in(table, similarity):
            for i, j in zip(a.tolist(), b.tolist(), strict=True):
                u, v = find(tops[i]), find(tops[j])
                if u != v and similar(whole[i].as_py(), whole[j].as_py(), similarity):
                    parent[max(u, v)] = min(u, v)
                    out.append((min(fp[i], fp[j]), max(fp[i], fp[j])))
        us, vs = zip(*out, strict=True) if out else ((), ())
        return pa.table([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _dealt_open(placed: DataFrame, block: int) -> DataFrame:
    """Rows (key, lo, hi, fp, n, root): the sets of buckets with several components, dealt to blocks so that all pairs across components meet.

    A bucket of one block is one group. In others the largest component is dealt once for each block of the other sets, these once for each block of it and of
    themselves: with m others of n sets that is some m x n / ``block`` rows beyond the n, and hardly more than n if few are left.
    """
    each = placed.groupBy("key", "root").agg(F.count("*").alias("size"))
    mixed = each.groupBy("key").agg(F.max_by("root", F.struct("size", F.bitwise_not("root"))).alias("main"), F.max("size").alias("top"), F.sum("size").alias("all"), F.count("*").alias("roots")).where("roots > 1")
    parts = lambda n: F.ceil(n / block).cast("long")
    mixed = mixed.select(F.col("key").alias("bucket"), "main", (F.col("all") <= block).alias("one"), parts(F.col("all") - F.col("top")).alias("others"), parts(F.col("top")).alias("mains"))
    rows = placed.join(mixed, F.col("key") == F.col("bucket"))
    whole = rows.where("one").withColumn("lo", F.lit(0).cast("long")).withColumn("hi", F.lit(0).cast("long"))
    rest, main = rows.where("not one and root <> main"), rows.where("not one and root = main")
    own = lambda n: F.pmod(F.xxhash64("fp"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    among = rest.withColumn("i", own("others")).withColumn("j", every("others")).withColumn("lo", F.least("i", "j")).withColumn("hi", F.greatest("i", "j"))
    left = rest.withColumn("lo", -1 - own("others")).withColumn("hi", every("mains"))
    right = main.withColumn("i", every("others")).withColumn("lo", -1 - F.col("i")).withColumn("hi", own("mains"))
    pick = lambda df: df.select("key", "lo", "hi", "fp", "n", "root")
    return pick(whole).unionByName(pick(among)).unionByName(pick(left)).unionByName(pick(right))


def _open_links(placed: DataFrame, own: DataFrame, held: DataFrame, similarity: float, block: int | None = None) -> DataFrame:
    """Links (u, v) of similar sets that meet in a bucket and are in different components, from rows (key, fp, n, root).

    A first pass over the blocks keeps the sets that are in a likely pair; only theirs are joined whole.
    """
    minima = own.select(F.col("fp").alias("_fp"), "sketch")
    dealt = _dealt_open(placed, block or BLOCK).join(minima, F.col("fp") == F.col("_fp")).drop("_fp")
    block_of = ["key", "lo", "hi"]
    hopeful = dealt.groupBy(*block_of).applyInArrow(_hopeful(similarity), "key long, lo long, hi long, fp long, n long, root long")
    hopeful = materialize(hopeful, "near-open", compact=True)
    whole = held.select(F.col("fp").alias("_held"), "shingles")
    rows = hopeful.join(minima, F.col("fp") == F.col("_fp")).join(whole, F.col("fp") == F.col("_held")).select(*hopeful.columns, "sketch", "shingles")
    return rows.groupBy(*block_of).applyInArrow(_forest(similarity), _PAIR)


def links(docs: DataFrame, marked: DataFrame, text: str = "text", size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (u, v): checked links of distinct sets ``fp`` that connect all that meet in a bucket and are similar enough."""
    one = marked.where("n > 0").groupBy("fp").agg(F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "keys", "sketch")))
    own = materialize(one, "distinct-sets", compact=True)
    members = own.select("fp", "n", "copies", F.explode("keys").alias("key"))
    # the most copied set of a bucket, by powers of 32; the key turns the order of the others, so that bands have different centres
    turned = F.col("fp").bitwiseXOR(F.col("key"))
    ranks = [F.min(F.when(F.col("copies") >= 32**k, turned)).alias(f"c{k}") for k in (3, 2, 1, 0)]
    centres = members.groupBy("key").agg(*ranks, F.count("*").alias("size")).where("size > 1")
    centres = centres.select(F.col("key").alias("bucket"), F.coalesce("c3", "c2", "c1", "c0").bitwiseXOR(F.col("key")).alias("centre"))
    met = materialize(members.join(centres, F.col("key") == F.col("bucket")).select("key", "fp", "n", "centre"), "met-sets", compact=True)
    ends = met.select(F.col("fp").alias("end")).distinct()
    held = with_sets(docs, text, size).join(ends, F.col("fp") == F.col("end"), "left_semi").groupBy("fp").agg(F.first("shingles").alias("shingles"))
    held = materialize(held, "met-whole-sets")
    stars = met.where("fp <> centre").select(F.least("fp", "centre").alias("u"), F.greatest("fp", "centre").alias("v")).distinct()
    sure = materialize(_checked(_likely(stars, own, similarity), held, similarity), "near-links", compact=True)
    roots = connected_components(sure)
    placed = met.join(roots, F.col("fp") == F.col("node"), "left").select("key", "fp", "n", F.coalesce("root", "fp").alias("root"))
    rest = _open_links(placed, own, held, similarity)
    stars = roots.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    return stars.union(rest)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """One row (doc_id, component_id) per document row."""
    marked = materialize(with_keys(docs, doc_id, text, size, similarity), "shingle-keys")
    return labelled(marked, links(docs, marked, text, size, similarity), doc_id)


def labelled(marked: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, component_id) of rows (doc, fp) whose sets have the links (u, v)."""
    roots = connected_components(found)
    own = marked.groupBy("fp").agg(F.min("doc").alias("least"))
    rooted = own.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # a table, so that both sides of the join with it are dealt afresh and a large component is split there
    least = materialize(rooted.groupBy(F.col("root").alias("top")).agg(F.min("least").alias("component")), "least-documents", compact=True)
    named = rooted.join(least, F.col("root") == F.col("top")).select(F.col("fp").alias("own"), "component")
    return marked.join(named, F.col("fp") == F.col("own")).select(F.col("doc").alias(doc_id), F.col("component").alias("component_id"))

"""Benchmark decontamination with a broadcast set of normalised test n-grams.

Texts are lower-cased (A-Z) and cut into words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. A window
is ``size`` consecutive words of a benchmark item; an item of fewer words (but not none) is
one window. A document word within any occurrence of a window is hit. Window hashes only
select candidates: each is compared word by word before it counts.

The set of distinct windows is broadcast in blocks of at most ``block_bytes`` of window text, so the
broadcast is bounded whatever the benchmark's size; documents pass once over each block, and
between blocks the hits found so far are written to the shared folder. Which items a window stands
in is not broadcast: it stays a table, joined to the distinct sets of classes of windows that documents hold,
so a window that many items share is one window to the scan. Documents are not shuffled but for
those joins, which carry the hit documents' named columns.

Defined results: null texts and null items have no words; items are told apart by id, and rows
that share an id are one item; items with a null id count as hits but are not reported. Ties
and repeated documents are judged row by row, and an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm import words as W
from sieveline.llm.batches import long, map_text, nested, slices, utf8
from sieveline.session import materialize

SIZE = 13
#: A document is contaminated if at least one word in RATIO of its words is hit.
RATIO = 20
#: Bytes of window text in one broadcast block.
BLOCK_BYTES = 64 << 20
#: Windows of an item that are made at a time.
_CHUNK = 20_000

_PAIR = T.ArrayType(T.LongType())


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    buf, offsets = utf8(column)
    buf = W.LOWER[buf]
    return buf, offsets, *W.words(buf, offsets, W.ALNUM)


def item_windows(benchmark: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """Rows (item, wid, words): every window of every item, its words joined by blanks and their 128-bit hash."""
    inner = T.StructType([T.StructField("item", benchmark.schema[item_id].dataType), T.StructField("wid", T.BinaryType()), T.StructField("words", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, 0):
                buf, _, s, e, first = _lowered(part.column(0))
                raw, begin = W.single_spaced(buf, s, e)
                n = np.diff(first)
                many = np.where(n > 0, np.maximum(n - size, 0) + 1, 0)
                row = np.repeat(np.arange(len(n)), many)
                start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[:-1], many)
                stop = begin[start + np.minimum(n[row], size)] - 1
                start = begin[start]
                for at in range(0, len(row), _CHUNK):
                    words = [raw[a:b] for a, b in zip(start[at : at + _CHUNK].tolist(), stop[at : at + _CHUNK].tolist(), strict=True)]
                    ids = part.column(1).take(pa.array(row[at : at + _CHUNK]))
                    wids = pa.array([xxhash.xxh3_128_digest(w) for w in words], pa.binary())
                    yield pa.RecordBatch.from_arrays([ids, wids, pa.array(words, pa.binary()).cast(pa.string())], names=inner.names)

    return benchmark.select(F.col(f"`{text}`").cast("string").alias("_t"), F.col(f"`{item_id}`").alias("item")).mapInArrow(run, inner)


class Index:
    """The distinct windows of one block in flat arrays: their words, hashes sorted for each length, and a gate of hash prefixes."""

    def __init__(self, windows: pa.Table):
        words = windows.column("words").combine_chunks()
        buf, self.offsets = utf8(words if isinstance(words, pa.Array) else pa.concat_arrays(words.chunks))
        self.raw = buf.tobytes()
        self.wids = b"".join(windows.column("wid").to_pylist())
        self.sizes = {}
        if not windows.num_rows:
            return
        s, e, first = W.words(buf, self.offsets, W.ALNUM)
        h, lengths = W.hashes(buf, s, e), np.diff(first)
        for size in np.unique(lengths).tolist():
            own, at = W.windows(h, first, size)
            rows = np.flatnonzero(lengths == size)
            own = own[np.searchsorted(at, first[:-1][rows])]
            order = np.argsort(own, kind="stable")
            gate = np.zeros(1 << 20, bool)
            gate[own >> np.uint64(44)] = True
            self.sizes[size] = (own[order], rows[order], gate)

    def find(self, buf, s, e, first) -> tuple[np.ndarray, list[list[bytes]]]:
        """Which words are hit, and the windows (wid) found in each text."""
        hit, found = np.zeros(len(s), bool), [set() for _ in first[1:]]
        if not self.sizes or not len(s):
            return hit, [[] for _ in found]
        h = W.hashes(buf, s, e)
        for size, (keys, rows, gate) in self.sizes.items():
            mine, at = W.windows(h, first, size)
            near = np.flatnonzero(gate[mine >> np.uint64(44)])
            low, high = (np.searchsorted(keys, mine[near], side) for side in ("left", "right"))
            places = []
            for i, a, b in zip(at[near[high > low]].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
                own = b" ".join(buf[s[k] : e[k]].tobytes() for k in range(i, i + size))
                for j in rows[a:b].tolist():
                    if self.raw[self.offsets[j] : self.offsets[j + 1]] == own:
                        places.append(i)
                        found[int(np.searchsorted(first, i, "right")) - 1].add(j)
            if places:
                hit |= W.cover(np.array(places), size, len(s))
        return hit, [sorted(self.wids[16 * j : 16 * j + 16] for j in x) for x in found]


def _runs(hit: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Word positions (start, end, start, end ...) of the runs of hit words in each text."""
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        own = hit[a:b]
        out.append(np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]))) if own.any() else np.zeros(0, np.int64))
    return out


def _blocks(windows: DataFrame, block_bytes: int) -> Iterator[pa.Table]:
    """Blocks of distinct windows (wid, words) for the driver, each bounded by ``block_bytes`` on the average of a hash."""
    total = windows.agg(F.sum(F.octet_length("words") + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        own = windows.where(F.pmod(F.xxhash64("wid"), F.lit(n)) == k) if n > 1 else windows
        yield own.toArrow()


def _with_items(out: DataFrame, held: DataFrame, kind: T.DataType, digest: bool) -> DataFrame:
    """``out`` with the items in which one of the found windows stands in place of found: their ids, or count and digest.

    Windows that stand in the same items are one class, which the first of them stands for: documents that share a passage
    differ in the windows they hold of it, but hardly in classes. Items are listed once for each distinct set of classes,
    and documents get that list, or, for the digest, no more than 40 bytes.
    """
    place = [c for c in out.columns if c != "found"]
    out = materialize(out, "decontaminated")
    hit = out.where(F.size("found") > 0).withColumn("set", F.md5(F.array_join(F.transform(F.array_sort("found"), F.hex), "")))
    # a set of items is told by its size and two sums (exclusive or) of hashes, which need no order and combine in the tasks
    made = held.groupBy("wid").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("a"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("b"))
    first = made.groupBy("n", "a", "b").agg(F.min("wid").alias("first"))
    classes = materialize(made.join(first, ["n", "a", "b"]).select(F.col("wid").alias("_wid"), "first"), "window-classes", compact=True)
    each = hit.select("set", "found").dropDuplicates(["set"]).select("set", F.explode("found").alias("wid"))
    each = each.join(classes, F.col("wid") == F.col("_wid")).groupBy("set").agg(F.array_sort(F.collect_set("first")).alias("firsts"))
    each = materialize(each.withColumn("classes", F.md5(F.array_join(F.transform("firsts", F.hex), ""))), "window-sets", compact=True)
    some = each.dropDuplicates(["classes"]).select("classes", F.explode("firsts").alias("first"))
    listed = some.join(held, F.col("first") == F.col("wid")).groupBy(F.col("classes").alias("_classes")).agg(F.array_sort(F.collect_set("item")).alias("items"))
    if digest:
        names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
        listed = listed.select("_classes", F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"))
        none = {"n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)}
    else:
        none = {"items": F.array().cast(T.ArrayType(kind))}
    listed = materialize(each.join(listed, F.col("classes") == F.col("_classes")).select(F.col("set").alias("_set"), *none), "contaminating-items", compact=True)
    with_hits = hit.join(listed, F.col("set") == F.col("_set"), "left").select(*place, *(F.coalesce(c, v).alias(c) for c, v in none.items()))
    return with_hits.unionByName(out.where(F.size("found") == 0).select(*place, *(v.alias(c) for c, v in none.items())))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SIZE,
    ratio: int = RATIO,
    block_bytes: int = BLOCK_BYTES,
    carry: list[str] | None = None,
    keep_text: bool = False,
    items: bool | str = True,
) -> DataFrame:
    """One row per document: the carried columns (the id if none are named), n_words, n_hit, items, spans, contaminated.

    ``items`` are the ids of all items with occurring windows: a list for each hit document, which is as long as the number of
    items that share its passages. With ``items="digest"`` there are n_items and items_sha256 (of the ids as strings, sorted
    and joined by commas) in their place, with ``items=False`` neither. ``spans`` are the word positions (start, end,
    start, end ...) of runs of hit words. A computed column replaces
    a carried one of the same name.
    """
    wids = T.ArrayType(T.BinaryType())
    fields = [long("n_words"), long("n_hit"), T.StructField("spans", _PAIR)] + [T.StructField("found", wids)] * bool(items)
    spark, carry = docs.sparkSession, carry or [doc_id]
    place = {c: f"_c{i}" for i, c in enumerate(dict.fromkeys([*carry, text]))}
    docs = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in place.items()))
    carried = [place[c] for c in place if c in carry]
    every = materialize(item_windows(benchmark, item_id, item_text, size), "benchmark-windows")
    blocks = _blocks(every.groupBy("wid").agg(F.first("words").alias("words")), block_bytes)
    index = Index(next(blocks))
    more = next(blocks, None)

    def judge(shared):
        def fn(column: pa.Array) -> dict[str, pa.Array]:
            buf, _, s, e, first = _lowered(column)
            hit, found = shared.value.find(buf, s, e, first)
            out = {"n_words": pa.array(np.diff(first)), "n_hit": pa.array(W.per_text(hit, first)), "spans": nested(_runs(hit, first), pa.int64())}
            return out | ({"found": pa.array(found, pa.list_(pa.binary()))} if items else {})

        return fn

    out = map_text(docs, place[text], judge(spark.sparkContext.broadcast(index)), fields, carried, keep_text=keep_text or more is not None)
    while more is not None:
        index = Index(more)
        done = materialize(out.withColumnsRenamed({"found": "_found", "spans": "_spans"}), "decontaminated")
        again = map_text(done, place[text], judge(spark.sparkContext.broadcast(index)), fields, done.columns, keep_text=True)
        merged = F.pandas_udf(_unions, _PAIR)("_spans", "spans")
        out = again.withColumn("spans", merged)
        out = out.withColumn("found", F.array_union("_found", "found")) if items else out
        out = out.drop("_found", "_spans")
        out = out.withColumn("n_hit", F.expr("aggregate(transform(spans, (x, i) -> if(i % 2 = 1, x, -x)), 0L, (a, x) -> a + x)"))
        more = next(blocks, None)
    columns = [c for c in place if c in carry and c != text] + [text] * keep_text
    told = ["n_items", "items_sha256"] if items == "digest" else ["items"] * bool(items)
    columns = [c for c in columns if c not in {"n_words", "n_hit", *told, "spans", "contaminated"}]
    out = out.select(*(place[c] for c in columns), *(f.name for f in fields))
    if items:
        held = every.where("item is not null").select("wid", "item").distinct()
        out = _with_items(out, held, benchmark.schema[item_id].dataType, items == "digest")
    return out.select(
        *(F.col(place[c]).alias(c) for c in columns), "n_words", "n_hit", *told, "spans",
        ((F.col("n_hit") > 0) & (ratio * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _unions(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_union(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)])


def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([_without(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)


def _union(a: list[int], b: list[int]) -> list[int]:
    """The union of two lists of spans."""
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2], b[1::2], strict=True)]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", **options) -> DataFrame:
    """The documents (all their columns) without contaminated ones, or, with ``remove="spans"``, without the hit spans.

    A removed span goes from its first word's first byte to its last word's last byte, in
    contaminated documents only; the text around it stays as it is.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is {remove!r}, not 'documents' or 'spans'")
    text, columns = options.get("text", "text"), docs.columns
    tagged = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)))
    place = {c: f"c{i}" for i, c in enumerate(columns)}
    inner = options | {"text": place[text], "doc_id": place[options.get("doc_id", "doc_id")]}
    found = scan(tagged, benchmark, **inner, carry=tagged.columns, keep_text=True, items=False)
    if remove == "documents":
        found = found.where(~F.col("contaminated"))
    else:
        cut = F.pandas_udf(_cut, T.StringType())
        found = found.withColumn(inner["text"], F.when(F.col("contaminated"), cut(inner["text"], "spans")).otherwise(F.col(inner["text"])))
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(columns)))


def _without(text: str | None, spans: list[int]) -> str | None:
    if text is None:
        return None
    raw = np.frombuffer(text.encode(), np.uint8)
    low = W.LOWER[raw] if len(raw) else raw
    s, e, _ = W.words(low, np.array([0, len(low)]), W.ALNUM)
    out, last = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(raw[last : s[a]].tobytes())
        last = e[b - 1]
    return b"".join([*out, raw[last:].tobytes()]).decode()

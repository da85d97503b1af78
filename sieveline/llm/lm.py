"""Stupid-backoff language model scores, computed relationally over the whole corpus.

N-grams of all orders are exploded from every document, counted in tables that are partitioned by
hash, joined back to the exploded n-grams, and summed per document:

    S(w | context) = c(context w) / c(context)   if the n-gram occurs ``min_count`` times or more,
                     alpha * S(w | shorter context) otherwise,
    S(w) = c(w) / N.

The relations travel in blocks. Each task cuts its documents, as they come, into groups of some
GROUP_BYTES of text (one longer text is a group of its own), so equal rows or hot ids make no group
larger. A group lists its distinct n-grams once, sorted by hash, with their counts (so a phrase that
every document has costs one entry a group), cut by ranges of the hash; empty ranges cost nothing, so
there are never more blocks than entries. A counting task gets one range from all groups, sums, and
answers each block with the corpus counts of its entries in the same order. The answers meet their
group again, whose documents look their n-grams up and add up. The exchange that deals the groups is
the same in both passes, so Spark writes it once. Nothing is collected or broadcast.

Words are `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; n-grams are told apart by 64-bit hashes that are not
verified: among 10^10 distinct n-grams some three pairs share their counts.

Defined results: null and wordless texts have no words and a score of 0 (and no mean). Rows that
share an id are documents of their own, repeated text counts as often as it occurs. Empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from sieveline.llm import words as W
from sieveline.llm.batches import SLICE_BYTES, slices, trim, utf8
from sieveline.session import materialize

ORDER = 3
ALPHA = 0.4
#: N-grams of more than one word that occur less often are not used.
MIN_COUNT = 2
#: Bytes of text in a group of documents and behind a range of hashes: what one task holds at a time.
GROUP_BYTES = 8 << 20
RANGE_BYTES = 16 << 20
_SALT = 0xD6E8FEB86659FD93


def _grams(column: pa.ChunkedArray, order: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Each text's first word, and for each order the hashes of all n-grams with the word they start at."""
    whole = column.combine_chunks()
    buf, offsets = utf8(whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks))
    buf = W.LOWER[buf]
    s, e, first = W.words(buf, offsets, W.SPACED)
    h = W.hashes(buf, s, e)
    out = []
    for k in range(1, order + 1):
        g, at = W.windows(h, first, k)
        out.append((W.mix(g + np.uint64(k * _SALT % (1 << 64))), at))
    return first, out


def _squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _expand(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _ranges(keys: np.ndarray, buckets: int) -> tuple[list[int], list[int]]:
    """Which of ``buckets`` ranges of hashes sorted keys lie in, and where each begins (and the end)."""
    width = np.uint64((1 << 64) // buckets + 1) if buckets > 1 else None
    place = keys // width if width else np.zeros(len(keys), np.uint64)
    cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return place[cut].astype(np.int64).tolist(), [*cut.tolist(), len(keys)]


def _grouped(group_bytes: int):
    """Groups of a task's documents, as rows (part, body): a number of their own and a compressed table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, part = 0, TaskContext.get().partitionId() << 32

        def made() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as out:
                for b in held:
                    out.write_batch(b)
            body = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([body], pa.binary())], names=["part", "body"])

        for whole in batches:
            for some in slices(whole, 1, min(group_bytes, SLICE_BYTES)):
                held.append(some)
                offsets = utf8(some.column(1))[1]
                size += int(offsets[-1])
                if size >= group_bytes:
                    yield made()
                    held, size, part = [], 0, part + 1
        if held:
            yield made()

    return run


def _opened(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_all()


#: Groups are made again if their task is: from an input of another order they would get other groups' counts.
_CHANGED = "the texts came in another order when they were read again; give a table that was written"

_ENTRIES = "part long, bucket long, n long, sign long, keys binary, counts binary"


def _sign(keys: np.ndarray) -> int:
    """What tells one block's n-grams from another's: both passes must see the same."""
    return int(np.bitwise_xor.reduce(W.mix(keys)).view(np.int64))


def _list(buckets: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            for part, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                trim()  # what the group before needed
                _, grams = _grams(_opened(body.as_py()).column("text"), order)
                keys, counts = np.unique(np.concatenate([g for g, _ in grams]), return_counts=True)
                del grams
                rows = []
                own, cut = _ranges(keys, buckets)
                for b, lo, hi in zip(own, cut[:-1], cut[1:], strict=True):
                    rows.append((part, b, hi - lo, _sign(keys[lo:hi]), _squeeze(np.diff(keys[lo:hi], prepend=np.uint64(0))), _squeeze(counts[lo:hi].astype("<u4"))))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "bucket", "n", "sign", "keys", "counts"])

    return run


def _count(table: pa.Table) -> pa.Table:
    """The corpus counts of one range, for each block of it."""
    trim()
    sizes = table.column("n").to_numpy()
    keys, counts = np.empty(sizes.sum(), np.uint64), np.empty(sizes.sum(), np.int64)
    at = 0
    for n, k, c in zip(sizes, table.column("keys"), table.column("counts"), strict=True):
        np.cumsum(_expand(k.as_py(), "<u8"), out=keys[at : at + n])
        counts[at : at + n] = _expand(c.as_py(), "<u4")
        at += n
    order = np.argsort(keys, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
    total = np.add.reduceat(counts[order], edges)
    counts[order] = np.repeat(total, np.diff(np.append(edges, len(keys))))
    ends = np.cumsum(sizes)
    answers = [_squeeze(counts[e - n : e].astype("<i8")) for n, e in zip(sizes, ends, strict=True)]
    return pa.table([table.column("part"), table.column("bucket"), table.column("sign"), pa.array(answers, pa.binary())], names=["part", "bucket", "sign", "totals"])


def _score(buckets: int, order: int, alpha: float, min_count: int, kind: pa.DataType):
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        trim()
        docs = pa.concat_tables([_opened(x.as_py()) for x in group.column("body")])
        first, grams = _grams(docs.column("text"), order)
        n = int(first[-1])
        keys, where = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        own, cut = _ranges(keys, buckets)
        place = dict(zip(own, zip(cut[:-1], cut[1:], strict=True), strict=True))
        if len(own) != answers.num_rows:
            raise ValueError(_CHANGED)
        for b, sign, data in zip(answers.column("bucket").to_pylist(), answers.column("sign").to_pylist(), answers.column("totals"), strict=True):
            if b not in place or _sign(keys[slice(*place[b])]) != sign:
                raise ValueError(_CHANGED)
            totals[slice(*place[b])] = _expand(data.as_py(), "<i8")
        count, seen = [], 0  # of the n-gram of each order that starts at a word
        for g, at in grams:
            own = np.zeros(n + 1, np.int64)
            own[at] = totals[where[seen : seen + len(g)]]
            seen += len(g)
            count.append(own)
        spot = np.arange(n)
        place = spot - np.repeat(first[:-1], np.diff(first))
        top = np.minimum(place + 1, order)
        score, done = np.zeros(n), np.zeros(n, bool)
        for k in range(order, 1, -1):
            start = np.maximum(spot - k + 1, 0)
            hit = (top >= k) & ~done & (count[k - 1][start] >= min_count)
            score[hit] = (top[hit] - k) * np.log(alpha) + np.log(count[k - 1][start[hit]]) - np.log(count[k - 2][start[hit]])
            done |= hit
        rest = ~done
        score[rest] = (top[rest] - 1) * np.log(alpha) + np.log(count[0][:n][rest])
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        sums = np.bincount(owner, weights=score, minlength=len(first) - 1)
        return pa.table(
            [docs.column("doc").cast(kind), pa.array(np.diff(first)), pa.array(W.per_text(rest, first)), pa.array(sums)], names=["doc", "n_words", "n_single", "part_score"]
        )

    return run


def score(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, alpha: float = ALPHA, min_count: int = MIN_COUNT,
    buckets: int | None = None, group_bytes: int | None = None,
) -> DataFrame:
    """One row (doc_id, n_words, n_backed_off, log_score, mean_log_score) per document row.

    ``log_score`` is the sum of the logarithms of S over its words, ``n_backed_off`` counts those that
    fell back to single words. ``buckets`` ranges of hashes and groups of ``group_bytes`` follow the size of
    the texts unless given: small inputs still make a dozen of either, so that all cores have work.
    Texts are read twice; if they do not come in the same order again (a shuffle whose tasks were run again), that is an error.
    """
    if not (buckets and group_bytes):
        size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
        buckets, group_bytes = buckets or max(12, -(-size // RANGE_BYTES)), group_bytes or min(GROUP_BYTES, max(1, size // 12))
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    groups = rows.mapInArrow(_grouped(group_bytes), "part long, body binary").repartition("part")
    entries = groups.mapInArrow(_list(buckets, order), _ENTRIES)
    answers = entries.groupBy("bucket").applyInArrow(_count, "part long, bucket long, sign long, totals binary")
    arrow = to_arrow_type(kind)
    inner = T.StructType([T.StructField("doc", kind), T.StructField("n_words", T.LongType()), T.StructField("n_single", T.LongType()), T.StructField("part_score", T.DoubleType())])
    found = groups.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_score(buckets, order, alpha, min_count, arrow), inner)
    found = materialize(found, "lm-scores")
    total = found.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("part_score") - F.col("n_single") * float(np.log(total))
    out = found.select(F.col("doc").alias("_doc"), "n_words", F.col("n_single").alias("n_backed_off"), log_score.alias("log_score"))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return out.select(F.col("_doc").alias(doc_id), "n_words", "n_backed_off", "log_score", mean.alias("mean_log_score"))

"""Inverted lists over vectors: an index for nearest neighbours, and an exact join of two sets of vectors by similarity.

Centroids are fitted by k-means on the driver, on at most ``SAMPLE_ROWS`` vectors (those of smallest hashed id) and of at most
``CENTROID_BYTES``; every vector of the table is then put on the list of its nearest centroid. Centroids are all that is
broadcast. Queries are routed to lists as rows and meet the lists' vectors in groups of (list, slice, block): a long list is
cut into slices of ``SLICE_ROWS`` vectors, many queries of one list into blocks of ``BLOCK_ROWS``, so no list, however much
of the table is on it, is one group, and neither side goes through the driver. Each group multiplies its two matrices.

``InvertedLists`` keeps the vectors partitioned by list: a search reads only the lists that are probed. It scores what is on them
exactly, so what an index can miss are neighbours on lists that are not probed; probing all lists is exact.

``similar_pairs`` is exact too, by cosine or by squared Euclidean distance. Angles between unit vectors, like distances, obey the
triangle inequality: a query at a distance a from a centroid has nobody within t on a list whose members are less than a - t or
more than a + t away from it. Lists that are not excluded are compared whole.

Null ids and vectors are left out, vectors of different sizes are an error. Zero vectors have the cosine 0.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.operators.vectors import _matrix, _unit
from sieveline.session import materialize

#: Vectors that centroids are fitted to, at most.
SAMPLE_ROWS = 20_000
#: Bytes of centroids that are broadcast, at most.
CENTROID_BYTES = 64 << 20
#: Vectors of a list, and queries that probe it, that one group holds on average.
SLICE_ROWS, BLOCK_ROWS = 20_000, 2_000
#: Lists that a search probes unless told otherwise, as a share of all.
PROBED = 0.6
#: Scores that a worker holds at a time.
_SCORES = 1 << 20
_ROUNDS = 12


def _pick(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, v) without nulls."""
    own = df.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{vector_col}`").isNotNull())
    return own.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<float>").alias("v"))


def _nearest(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids."""
    return np.maximum((m**2).sum(1)[:, None] + (centres**2).sum(1)[None] - 2 * m @ centres.T, 0)


def _same(m: np.ndarray) -> np.ndarray:
    return m


#: What becomes of vectors before they are compared.
_PREPARED = {"cosine": _unit, "l2": _same}


def fit(vectors: DataFrame, lists: int, sample_rows: int = SAMPLE_ROWS, metric: str = "cosine") -> np.ndarray:
    """At most ``lists`` centroids of rows (id, v), for cosines of unit vectors, from the ``sample_rows`` of them with the smallest hashed ids."""
    prepared = _PREPARED[metric]
    sample = prepared(_matrix(vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow().column("v").combine_chunks()))
    if not len(sample):
        return np.zeros((0, 0))
    lists = max(1, min(lists, len(sample), CENTROID_BYTES // (8 * sample.shape[1])))
    rng = np.random.default_rng(7)
    centres = sample[rng.permutation(len(sample))[:lists]]
    for _ in range(_ROUNDS):
        own = np.concatenate([np.argmin(_nearest(sample[at : at + 4096], centres), axis=1) for at in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        held = np.bincount(own, minlength=lists)[:, None]
        centres = np.where(held > 0, prepared(sums / np.maximum(held, 1)), centres)
    return centres


def _steps(batches: Iterator[pa.RecordBatch], width: int, dim: int, metric: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with their prepared vectors, so that rows times width stays bounded."""
    step = max(1, _SCORES // max(width, 1))
    for batch in (whole.slice(at, step) for whole in batches for at in range(0, whole.num_rows, step)):
        m = _matrix(batch.column(1))
        if m.shape[1] != dim:
            raise ValueError(f"vectors of different sizes: {dim}, {m.shape[1]}")
        yield batch, _PREPARED[metric](m)


def _away(m: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Angles or distances of prepared rows to centroids."""
    return np.arccos(np.clip(m @ centres.T, -1, 1)) if metric == "cosine" else np.sqrt(_nearest(m, centres))


def assign(vectors: DataFrame, centres: np.ndarray, metric: str = "cosine") -> DataFrame:
    """Rows (id, v, list, away): the list of each vector's nearest centroid, and the angle or distance to it."""
    shared = vectors.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, m in _steps(batches, len(own), own.shape[1], metric):
            away = _away(m, own, metric)
            near = np.argmin(away, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(near)), near])], names=["id", "v", "list", "away"])

    return vectors.mapInArrow(run, "id long, v array<float>, list int, away double")


def _routed(queries: DataFrame, centres: np.ndarray, choose: Callable[[np.ndarray], np.ndarray], metric: str = "cosine") -> DataFrame:
    """Rows (query_id, q, list): each query once for each list that ``choose`` takes, given how far it is from all centroids."""
    shared = queries.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, m in _steps(batches, len(own), own.shape[1], metric):
            rows, lists = np.nonzero(choose(_away(m, own, metric)))
            step = max(1, _SCORES // own.shape[1])
            for at in range(0, len(rows), step):
                take = pa.array(rows[at : at + step])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(lists[at : at + step].astype(np.int32))], names=["query_id", "q", "list"])

    return queries.mapInArrow(run, "query_id long, q array<float>, list int")


def _group(k: int | None, least: float | None, exclude_self: bool, metric: str):
    """The matches of a group's queries among a group's vectors: ``k`` a query, or all, that score ``least`` or more (distances count below 0)."""

    def run(key: tuple, queries: pa.Table, members: pa.Table) -> pa.Table:
        who, found, score = [], [], []
        if queries.num_rows and members.num_rows:
            members = members.sort_by("id")
            ids, names = members.column("id").to_numpy(), queries.column("query_id").to_numpy()
            m, q = (_PREPARED[metric](_matrix(t.column(c).combine_chunks())) for t, c in ((members, "v"), (queries, "q")))
            if m.shape[1] != q.shape[1]:
                raise ValueError(f"vectors of different sizes: {q.shape[1]}, {m.shape[1]}")
            step = max(1, _SCORES // len(ids))
            for at in range(0, len(names), step):
                s = q[at : at + step] @ m.T if metric == "cosine" else -_nearest(q[at : at + step], m)
                if exclude_self:
                    s[names[at : at + step, None] == ids[None]] = -np.inf
                if least is not None:
                    s[s < least] = -np.inf
                if k is not None and k < len(ids):
                    s[s < np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k][:, None]] = -np.inf  # ties with the k-th stay
                rows, columns = np.nonzero(np.isfinite(s))
                if k is not None and len(rows):  # and go by id
                    order = np.lexsort((ids[columns], -s[rows, columns], rows))
                    rows, columns = rows[order], columns[order]
                    first = np.concatenate([[0], np.flatnonzero(np.diff(rows)) + 1])
                    place = np.arange(len(rows)) - np.repeat(first, np.diff(np.concatenate([first, [len(rows)]])))
                    rows, columns = rows[place < k], columns[place < k]
                who.append(names[at + rows])
                found.append(ids[columns])
                score.append(s[rows, columns])
        flat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query_id": flat(who, np.int64), "similar_id": flat(found, np.int64), "score": flat(score, np.float64)})

    return run


def _matches(probes: DataFrame, members: DataFrame, k: int | None, least: float | None, exclude_self: bool, slice_rows: int, block_rows: int, metric: str = "cosine") -> DataFrame:
    """Rows (query_id, similar_id, score) of what each query finds on the lists it was routed to."""
    sizes = members.groupBy("list").agg(F.count("*").alias("n")).join(probes.groupBy("list").agg(F.count("*").alias("p")), "list")
    deal = sizes.select(F.col("list").alias("_list"), F.ceil(F.col("n") / slice_rows).alias("slices"), F.ceil(F.col("p") / block_rows).alias("blocks"))
    of = lambda key, n: F.pmod(F.xxhash64(key), n)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    own = members.join(deal, F.col("list") == F.col("_list")).select("list", of("id", F.col("slices")).alias("slice"), each(F.col("blocks")).alias("block"), "id", "v")
    asked = probes.join(deal, F.col("list") == F.col("_list")).select("list", each(F.col("slices")).alias("slice"), of("query_id", F.col("blocks")).alias("block"), "query_id", "q")
    keys = ["list", "slice", "block"]
    return asked.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInArrow(_group(k, least, exclude_self, metric), "query_id long, similar_id long, score double")


def _ranked(found: DataFrame, k: int | None) -> DataFrame:
    """With rn by score and id; rows that share an id count once, with their best score."""
    once = found.repartition("query_id").groupBy("query_id", "similar_id").agg(F.max("score").alias("score"))
    out = once.withColumn("rn", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "similar_id")))
    return out if k is None else out.where(F.col("rn") <= k)


class InvertedLists:
    """Vectors of a folder, partitioned by the list of their nearest centroid."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, vectors: DataFrame, lists: int | None = None, sample_rows: int = SAMPLE_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> InvertedLists:
        """Fit centroids (the square root of the number of vectors, unless ``lists`` says how many) and write every vector to its list."""
        own = _pick(vectors, id_col, vector_col)
        centres = fit(own, lists or max(1, int(own.count() ** 0.5)), sample_rows)
        rows = [(k, c.tolist()) for k, c in enumerate(centres)]
        self.spark.createDataFrame(rows, "list int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/centres")
        self._write(own, centres, "overwrite")
        return self

    def add(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> None:
        """Write more vectors to the lists of the centroids that there are."""
        self._write(_pick(vectors, id_col, vector_col), self.centres(), "append")

    def _write(self, own: DataFrame, centres: np.ndarray, mode: str) -> None:
        if not len(centres) and mode == "append" and own.limit(1).count():
            raise ValueError("the index was built without vectors: build it again")
        put = assign(own, centres) if len(centres) else own.select("id", "v", F.lit(0).alias("list"), F.lit(0.0).alias("away")).limit(0)
        # ranges of (list, hash): a task writes few lists, and a long list is written by several tasks
        put.repartitionByRange(F.col("list"), F.xxhash64("id")).write.mode(mode).partitionBy("list").parquet(f"{self.path}/lists")

    def centres(self) -> np.ndarray:
        rows = self.spark.read.schema("list int, centre array<double>").parquet(f"{self.path}/centres").orderBy("list").collect()  # CENTROID_BYTES at most
        return np.array([r.centre for r in rows]) if rows else np.zeros((0, 0))

    def members(self) -> DataFrame:
        return self.spark.read.schema("id long, v array<float>, away double, list int").parquet(f"{self.path}/lists")

    def search(
        self, queries: DataFrame, k: int, nprobe: int | None = None, min_similarity: float | None = None, exclude_self: bool = True, id_col: str = "vec_id", vector_col: str = "embedding",
        slice_rows: int = SLICE_ROWS, block_rows: int = BLOCK_ROWS,
    ) -> DataFrame:
        """Rows (query_id, similar_id, score, rn): the ``k`` most similar (cosine) vectors on the ``nprobe`` lists nearest to each query.

        Without ``nprobe``, PROBED of the lists. Ties go to the smaller id.
        """
        centres = self.centres()
        if not len(centres):
            return self.spark.createDataFrame([], "query_id long, similar_id long, score double, rn int")
        n = min(nprobe or max(1, round(PROBED * len(centres))), len(centres))

        def nearest(away: np.ndarray) -> np.ndarray:
            out = np.zeros(away.shape, bool)
            np.put_along_axis(out, np.argpartition(away, n - 1, axis=1)[:, :n], True, axis=1)
            return out

        probes = materialize(_routed(_pick(queries, id_col, vector_col), centres, nearest), "probes")
        asked = [r["list"] for r in probes.select("list").distinct().collect()]  # no more than there are lists: prunes partitions
        members = self.members().where(F.col("list").isin(asked)) if len(asked) < len(centres) else self.members()
        return _ranked(_matches(probes, members, k, min_similarity, exclude_self, slice_rows, block_rows), k)


def similar_pairs(
    new: DataFrame, stored: DataFrame, threshold: float, k: int | None = None, lists: int | None = None, exclude_self: bool = False, id_col: str = "vec_id", vector_col: str = "embedding",
    slice_rows: int = SLICE_ROWS, block_rows: int = BLOCK_ROWS, metric: str = "cosine",
) -> DataFrame:
    """Rows (query_id, similar_id, score, rn): the stored vectors that are near enough to each new one, exactly; with ``k`` the best so many of each.

    Near enough is a cosine of ``threshold`` (above 0) or more, or, for ``metric="l2"``, a squared distance of ``threshold`` or less.
    Either side may be of any size.
    """
    if metric not in _PREPARED:
        raise ValueError(f"metric is {metric!r}, not one of {tuple(_PREPARED)}")
    if not (0 < threshold <= 1 if metric == "cosine" else threshold >= 0):
        raise ValueError(f"the threshold is {threshold}, not " + ("above 0 and at most 1" if metric == "cosine" else "0 or more"))
    own, asked = _pick(stored, id_col, vector_col), _pick(new, id_col, vector_col)
    centres = fit(own, lists or max(1, int(own.count() ** 0.5)), metric=metric)
    if not len(centres):
        return new.sparkSession.createDataFrame([], "query_id long, similar_id long, score double, rn int")
    members = materialize(assign(own, centres, metric), "listed-vectors")
    reach = members.groupBy("list").agg(F.min("away").alias("low"), F.max("away").alias("high")).collect()  # a row for each list
    low, high = np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
    for r in reach:
        low[r["list"]], high[r["list"]] = r.low, r.high
    wide = (np.arccos(threshold) if metric == "cosine" else np.sqrt(threshold)) + 1e-6

    def may_hold(away: np.ndarray) -> np.ndarray:
        return (away >= low - wide) & (away <= high + wide)

    probes = materialize(_routed(asked, centres, may_hold, metric), "probes")
    least = (threshold if metric == "cosine" else -threshold) - 1e-12
    found = _ranked(_matches(probes, members.select("id", "v", "list"), k, least, exclude_self, slice_rows, block_rows, metric), k)
    return found if metric == "cosine" else found.withColumn("score", -F.col("score"))


def split_new(new: DataFrame, stored: DataFrame, threshold: float, k: int = 5, id_col: str = "vec_id", **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New rows that resemble no stored vector, those that do, and the mappings (id, similar_id, score, rn) of the second, ``k`` each.

    New vectors are not compared with each other; rows without an id or a vector resemble none.
    """
    found = materialize(similar_pairs(new, stored, threshold, k, id_col=id_col, **options), "similar-vectors", compact=True)
    hit = found.where("rn = 1").select(F.col("query_id").alias("_hit"))
    same = new[f"`{id_col}`"] == hit["_hit"]
    return new.join(hit, same, "left_anti"), new.join(hit, same, "left_semi"), found.select(F.col("query_id").alias(id_col), "similar_id", "score", "rn")


def flag_new(new: DataFrame, existing: DataFrame, threshold: float, k: int = 5, compat: bool = False, id_col: str = "vec_id", vector_col: str = "embedding", content_col: str | None = None) -> DataFrame:
    """New vectors with ``is_duplicate``: whether an existing one is at least ``threshold`` similar (cosine).

    By default a new item whose content key is already stored is a duplicate too. With ``compat``
    such a hit counts as the item itself and is ignored, and the search is for k + 1 neighbours.
    Either way new items are not compared with each other.
    """
    hits = similar_pairs(new, existing, threshold, k + 1 if compat else k, id_col=id_col, vector_col=vector_col)
    if compat and content_col:
        a = new.select(F.col(id_col).alias("query_id"), F.col(content_col).alias("_a"))
        b = existing.select(F.col(id_col).alias("similar_id"), F.col(content_col).alias("_b"))
        hits = hits.join(a, "query_id").join(b, "similar_id").where(~F.col("_a").eqNullSafe(F.col("_b")))
    found = hits.select(F.col("query_id").alias("_hit")).distinct()
    out = new.join(found, F.col(id_col) == F.col("_hit"), "left").withColumn("is_duplicate", F.col("_hit").isNotNull()).drop("_hit")
    if content_col and not compat:
        known = existing.select(F.col(content_col).alias("_known")).where("_known is not null").distinct()
        out = out.join(known, F.col(content_col) == F.col("_known"), "left").withColumn("is_duplicate", F.col("is_duplicate") | F.col("_known").isNotNull()).drop("_known")
    return out

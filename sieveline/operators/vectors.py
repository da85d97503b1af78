"""Exact nearest neighbours and the rules built on them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.session import remove

METRICS = ("cosine", "ip", "l2")
#: Query vectors that one pass over the table compares against (a bounded broadcast).
BLOCK_ROWS = 4096
#: Scores that a worker holds at a time.
_SCORES = 1 << 20


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal sizes as rows of doubles."""
    if not len(column):
        return np.zeros((0, 0))
    sizes = np.unique(np.diff(column.offsets.to_numpy()))
    if len(sizes) != 1:
        raise ValueError(f"vectors of different sizes: {sizes.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), sizes[0])


def _unit(m: np.ndarray) -> np.ndarray:
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, size, out=np.zeros_like(m), where=size > 0)


def knn(
    queries: DataFrame, vectors: DataFrame, k: int, metric: str = "cosine", min_similarity: float | None = None, max_distance: float | None = None,
    exclude_self: bool = True, strict: bool = False, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows (query_id, similar_id, score, rn): the ``k`` best vectors of each query, exactly.

    ``cosine`` and ``ip`` score by similarity (best first: high; bound by ``min_similarity``),
    ``l2`` by squared distance (best first: low; bound by ``max_distance``); ``strict`` leaves the
    bound itself out. Ties go to the smaller id. Zero vectors have cosine 0; null vectors and ids
    are left out; different sizes are an error.

    The query set goes out in broadcast blocks of at most ``block_rows`` vectors. Every task
    multiplies the block with as many rows at a time as make _SCORES scores and keeps ``k`` a query,
    so that what is shuffled is ``k`` rows a query and task, however large the table is.
    """
    if metric not in METRICS:
        raise ValueError(f"metric is {metric!r}, not one of {METRICS}")
    if (metric == "l2" and min_similarity is not None) or (metric != "l2" and max_distance is not None):
        raise ValueError("l2 is bounded by max_distance, cosine and ip by min_similarity")
    pick = lambda df: df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    sign = 1.0 if metric == "l2" else -1.0
    bound = max_distance if metric == "l2" else None if min_similarity is None else -min_similarity
    table = pick(vectors)

    context = vectors.sparkSession.sparkContext

    def block(rows: list) -> DataFrame:
        own = np.array([r.v for r in rows], np.float64)
        own = _unit(own) if metric == "cosine" else own
        shared = context.broadcast((np.array([r.id for r in rows], np.int64), own))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, own = shared.value
            best_key, best_id = np.full((len(ids), k), np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
            size = (own**2).sum(1)[:, None]
            step = max(k, _SCORES // len(ids), 1)
            for batch in (whole.slice(at, step) for whole in batches for at in range(0, whole.num_rows, step)):
                theirs, m = batch.column(0).to_numpy(), _matrix(batch.column(1))
                if m.shape[1] != own.shape[1]:
                    raise ValueError(f"vectors of different sizes: {own.shape[1]}, {m.shape[1]}")
                if metric == "l2":
                    key = np.maximum(size + (m**2).sum(1)[None] - 2 * own @ m.T, 0)
                else:
                    key = -(own @ (_unit(m) if metric == "cosine" else m).T)
                if exclude_self:
                    key[ids[:, None] == theirs[None]] = np.inf
                if bound is not None:
                    key[(key >= bound) if strict else (key > bound)] = np.inf
                # only queries that have something at least as good as their last one so far
                better = np.flatnonzero((key <= best_key[:, -1:]).any(axis=1) & np.isfinite(key).any(axis=1))
                for q in better.tolist():
                    mine = np.flatnonzero((key[q] <= best_key[q, -1]) & np.isfinite(key[q]))
                    if len(mine) > k:  # ties with the k-th stay, the sort below decides by id
                        mine = mine[key[q, mine] <= np.partition(key[q, mine], k - 1)[k - 1]]
                    keys, who = np.concatenate([best_key[q], key[q, mine]]), np.concatenate([best_id[q], theirs[mine]])
                    order = np.lexsort((who, keys))[:k]
                    best_key[q], best_id[q] = keys[order], who[order]
            rows, columns = np.nonzero(np.isfinite(best_key))
            yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(best_id[rows, columns]), pa.array(sign * best_key[rows, columns])], names=["query_id", "similar_id", "score"])

        found = table.mapInArrow(run, "query_id long, similar_id long, score double")
        order = F.col("score").asc() if metric == "l2" else F.col("score").desc()
        return found.withColumn("rn", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "similar_id"))).where(F.col("rn") <= k)

    parts, rows = [], []
    for row in pick(queries).toLocalIterator():
        rows.append(row)
        if len(rows) == block_rows:
            parts.append(block(rows))
            rows = []
    if rows:
        parts.append(block(rows))
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, similar_id long, score double, rn int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def relevance(neighbours: DataFrame, ratings: DataFrame, id_col: str, rating_col: str, queries: DataFrame, query_col: str) -> DataFrame:
    """Rows (query_id, relevance): the mean rating of each query's neighbours, -1 for a query without any."""
    rated = neighbours.join(ratings.select(F.col(id_col).alias("similar_id"), F.col(rating_col).cast("double").alias("_rating")), "similar_id")
    mean = rated.groupBy("query_id").agg(F.avg("_rating").alias("_mean"))
    return queries.select(F.col(query_col).alias("query_id")).join(mean, "query_id", "left").select("query_id", F.coalesce("_mean", F.lit(-1.0)).alias("relevance"))


class Collection:
    """Vectors of one model in a folder, partitioned by day."""

    def __init__(self, spark: SparkSession, path: str, days: int = 3):
        self.spark, self.path, self.days = spark, path.rstrip("/"), days

    SCHEMA = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("ds", T.DateType())])

    def exists(self) -> bool:
        fs, folder = self._folder()
        return fs.exists(folder)

    def create(self) -> None:
        """An empty collection, if there is none."""
        if not self.exists():
            self.spark.createDataFrame([], self.SCHEMA).write.parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)

    def reset(self) -> None:
        """Drop it and create it empty."""
        self.drop()
        self.create()

    def drop_day(self, ds: str) -> None:
        remove(self.spark, f"{self.path}/ds={ds}")

    def drop_expired(self, run_ds: str) -> list[str]:
        """Drop the days that are past retention; which these were."""
        old = sorted(str(r.ds) for r in self.expired(run_ds).collect())
        for ds in old:
            self.drop_day(ds)
        return old

    def days_held(self) -> DataFrame:
        return self.read().select("ds").distinct()

    def peek(self, n: int = 10) -> DataFrame:
        """The first ``n`` rows by day and id."""
        return self.read().orderBy("ds", "item_id").limit(n)

    def count(self) -> int:
        return self.read().count()

    def _folder(self):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def insert(self, rows: DataFrame) -> None:
        """Append rows (item_id, embedding, ds)."""
        rows.select("item_id", "embedding", "ds").write.mode("append").partitionBy("ds").parquet(self.path)

    def day(self, ds: str, fallback: bool = True) -> DataFrame:
        """The vectors of a day, or of the day before if it has none."""
        both = self.read().where(F.col("ds").isin(ds, *([str(np.datetime64(ds) - 1)] if fallback else [])))
        last = both.where(F.col("ds") <= ds).agg(F.max("ds").alias("last"))
        return both.join(F.broadcast(last), F.col("ds") == F.col("last"), "left_semi")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def stats(self) -> DataFrame:
        return self.read().groupBy("ds").agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim"))

    def expired(self, run_ds: str) -> DataFrame:
        """The days that retention drops."""
        return self.read().select("ds").distinct().where(F.col("ds") <= F.date_sub(F.lit(run_ds).cast("date"), self.days))

"""The vector index, similarity joins of two sets and their streams as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import lists
from sieveline.plans.queries import _COS, _searched, query
from sieveline.session import shared_path
from sieveline.session import table as read
from sieveline.streaming import streams

#: Similarity from which the (unrelated) vectors of the table count as duplicates.
ALIKE = 0.375


def _rows(found):
    return found.select("query_id", "similar_id", F.round("score", 6).alias("score"), "rn")


@query(f"WITH {_COS} SELECT query_id, similar_id, round(sim, 6) AS score, CAST(rn AS INTEGER) AS rn FROM k WHERE rn <= 5")
def listed_knn_all_probed(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    index = lists.InvertedLists(spark, shared_path(spark, "lists")).build(v)
    return _rows(index.search(_searched(v), 5, nprobe=len(index.centres())))


@query()
def listed_knn(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return _rows(lists.InvertedLists(spark, shared_path(spark, "lists")).build(v).search(_searched(v), 5))


_PAIRS = f"""n AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a FROM embeddings WHERE vec_id % 10 = 0), e AS (SELECT vec_id AS similar_id, CAST(embedding AS DOUBLE[]) AS b FROM embeddings WHERE vec_id % 10 <> 0),
m AS (SELECT vec_id, similar_id, list_cosine_similarity(a, b) AS sim FROM n, e WHERE list_cosine_similarity(a, b) >= {ALIKE}), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, similar_id) AS rn FROM m)"""


def _halves(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return v.where("vec_id % 10 = 0"), v.where("vec_id % 10 <> 0")


@query(f"WITH {_PAIRS} SELECT vec_id, list(similar_id ORDER BY rn) FILTER (rn IS NOT NULL) AS similar_ids, round(max(sim), 6) AS best, max(rn) IS NOT NULL AS is_duplicate FROM n LEFT JOIN (SELECT * FROM r WHERE rn <= 5) r USING (vec_id) GROUP BY vec_id")
def dedup_mappings(spark, sf_dir):
    unique, duplicates, mappings = lists.split_new(*_halves(spark, sf_dir), ALIKE)
    own = mappings.groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("rn", "similar_id"))).alias("s"), F.round(F.max("score"), 6).alias("best"))  # five at most
    marked = duplicates.select("vec_id", F.lit(True).alias("is_duplicate")).unionByName(unique.select("vec_id", F.lit(False).alias("is_duplicate")))
    return marked.join(own, "vec_id", "left").select("vec_id", F.transform("s", lambda x: x.similar_id).alias("similar_ids"), "best", "is_duplicate")


@query(f"WITH {_PAIRS} SELECT vec_id AS query_id, similar_id, round(sim, 6) AS score, CAST(rn AS INTEGER) AS rn FROM r")
def similar_pairs(spark, sf_dir):
    return _rows(lists.similar_pairs(*_halves(spark, sf_dir), ALIKE))


@query(f"WITH {_PAIRS} SELECT vec_id FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM m)")
def stream_unique_vectors(spark, sf_dir):
    new, stored = _halves(spark, sf_dir)
    path = shared_path(spark, "unique-vectors")
    stored.select("vec_id", "embedding").write.parquet(f"{path}/store/vectors/{streams.EPOCH}=-1")
    for _ in range(2):
        stream = spark.readStream.schema(new.schema).parquet(f"{sf_dir}/embeddings.parquet*").where("vec_id % 10 = 0")
        streams.unique_vectors(stream, f"{path}/store", ALIKE, f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/store/vectors").select("vec_id")

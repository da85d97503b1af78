import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.operators import lists as L
from sieveline.operators import vectors as K
from sieveline.streaming import streams

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clustered(n, dim=16, centres=12, seed=0, hot=0.3):
    """Vectors around centres, of which the first has a large share."""
    rng = np.random.RandomState(seed)
    c = rng.randn(centres, dim)
    who = np.where(rng.rand(n) < hot, 0, rng.randint(0, centres, n))
    return [(i, [float(x) for x in c[w] + 0.4 * rng.randn(dim)]) for i, w in enumerate(who)]


def rounded(df):
    return sorted((r.query_id, r.rn, r.similar_id, round(r.score, 9)) for r in df.collect())


def test_probing_all_lists_is_exact(spark, tmp_path):
    v = table(spark, clustered(500)).repartition(4)
    index = L.InvertedLists(spark, str(tmp_path / "i")).build(v, 20)
    want = rounded(K.knn(v.where("vec_id % 10 = 0"), v, 5))
    for slices, blocks in ((20_000, 2_000), (7, 3)):
        assert rounded(index.search(v.where("vec_id % 10 = 0"), 5, nprobe=20, slice_rows=slices, block_rows=blocks)) == want
    assert index.members().count() == 500
    assert rounded(index.search(v.where("vec_id % 10 = 0"), 5, nprobe=99, min_similarity=0.9)) == rounded(K.knn(v.where("vec_id % 10 = 0"), v, 5, min_similarity=0.9))


def recall(got, want):
    pairs = {(r[0], r[2]) for r in want}
    return len(pairs & {(r[0], r[2]) for r in got}) / len(pairs)


@pytest.mark.parametrize("rows", [clustered(3000), [(i, np.random.RandomState(i).randn(64).tolist()) for i in range(2000)]], ids=["clusters", "noise"])
def test_recall_at_the_default(spark, tmp_path, rows):
    v = table(spark, rows).repartition(4)
    index = L.InvertedLists(spark, str(tmp_path / "i")).build(v)
    q = v.where("vec_id % 50 = 0")
    assert recall(rounded(index.search(q, 10)), rounded(K.knn(q, v, 10))) >= 0.9


def test_recall_with_few_lists_of_clusters(spark, tmp_path):
    v = table(spark, clustered(3000)).repartition(4)
    index = L.InvertedLists(spark, str(tmp_path / "i")).build(v, 12, sample_rows=300)
    q = v.where("vec_id % 50 = 0")
    near = index.search(q, 10, nprobe=3)
    assert recall(rounded(near), rounded(K.knn(q, v, 10))) >= 0.9
    one = index.search(q.limit(1), 10, nprobe=1)
    held = index.members().join(one.select(F.col("similar_id").alias("id")), "id")
    assert one.count() == 10 and held.select("list").distinct().count() == 1


def test_adding_nulls_zeros_ties_and_errors(spark, tmp_path):
    v = table(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, [0.0, 0.0]), (6, None), (None, [1.0, 0.0])])
    index = L.InvertedLists(spark, str(tmp_path / "i")).build(v, 2)
    index.add(table(spark, [(7, [1.0, 0.0])]))
    got = [(r.similar_id, r.score) for r in index.search(v.where("vec_id = 1"), 9, nprobe=2).orderBy("rn").collect()]
    assert got == [(2, 1.0), (3, 1.0), (7, 1.0), (4, 0.0), (5, 0.0)]
    with pytest.raises(Exception, match="different sizes"):
        index.search(table(spark, [(9, [1.0])]), 1).collect()
    empty = L.InvertedLists(spark, str(tmp_path / "e")).build(v.limit(0))
    assert empty.search(v, 3).collect() == [] and index.search(v.limit(0), 3).collect() == []


def brute_pairs(new, stored, threshold):
    unit = lambda v: np.array(v) / (np.linalg.norm(v) or 1)
    return {(i, j) for i, a in new for j, b in stored if unit(a) @ unit(b) >= threshold}


@pytest.mark.parametrize("threshold", [0.3, 0.9, 0.97])
def test_similar_pairs_are_exact(spark, threshold):
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in clustered(600, seed=3)]
    new, stored = rows[:150], rows[150:]
    want = brute_pairs(new, stored, threshold)
    for options in ({}, {"slice_rows": 9, "block_rows": 4, "lists": 5}, {"lists": 1}):
        got = {(r.query_id, r.similar_id) for r in L.similar_pairs(table(spark, new), table(spark, stored), threshold, **options).collect()}
        assert got == want, options


@pytest.mark.parametrize("bound", [0.0, 0.5, 4.0])
def test_pairs_by_distance_are_exact(spark, bound):
    rows = [(i, np.float32(v).astype(float).tolist()) for i, v in clustered(500, dim=6, seed=4)] + [(900, [0.0] * 6), (901, [0.0] * 6)]
    new, stored = rows[:120] + [rows[-2], rows[300]], rows[100:]
    want = sorted((i, j) for i, a in new for j, b in stored if ((np.array(a) - np.array(b)) ** 2).sum() <= bound)
    for options in ({}, {"slice_rows": 9, "block_rows": 4, "lists": 5}):
        got = L.similar_pairs(table(spark, new), table(spark, stored), bound, metric="l2", **options).collect()
        assert sorted((r.query_id, r.similar_id) for r in got) == want
        assert all(r.score >= 0 for r in got)
    exact = K.knn(table(spark, new), table(spark, stored), 3, "l2", max_distance=bound, exclude_self=False)
    assert rounded(L.similar_pairs(table(spark, new), table(spark, stored), bound, 3, metric="l2")) == rounded(exact)
    with pytest.raises(ValueError, match="metric"):
        L.similar_pairs(table(spark, new), table(spark, stored), 1, metric="ip")


def test_the_triangle_excludes_lists(spark):
    stored, new = table(spark, clustered(600, hot=0)), table(spark, clustered(50, hot=0))
    own = L._pick(stored, "vec_id", "embedding")
    centres = L.fit(own, 24)
    pairs = L.similar_pairs(new, stored, 0.95, lists=24)
    assert pairs.count() > 0
    seen = {}
    keep = L._routed
    L._routed = lambda *a: seen.setdefault("df", keep(*a))
    try:
        L.similar_pairs(new, stored, 0.95, lists=24).collect()
    finally:
        L._routed = keep
    assert seen["df"].count() < 0.7 * 50 * len(centres)


def test_split_with_mappings(spark):
    old = table(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.02])])
    new = table(spark, [(10, [1.0, 0.01]), (11, [0.7, 0.7]), (12, [0.0, 1.0]), (13, None), (None, [1.0, 0.0]), (10, [1.0, 0.01])]).withColumn("_hit", F.lit("x"))
    unique, duplicates, mappings = L.split_new(new, old, 0.9, k=2)
    assert sorted(map(str, (r.vec_id for r in unique.collect()))) == ["11", "13", "None"]
    assert [r.vec_id for r in duplicates.orderBy("vec_id").collect()] == [10, 10, 12]
    assert {(r.vec_id, r.similar_id) for r in mappings.collect()} == {(10, 1), (10, 3), (12, 2)}
    unique, duplicates, mappings = L.split_new(new, old.limit(0), 0.9)
    assert unique.count() == 6 and duplicates.count() == 0 and mappings.count() == 0
    with pytest.raises(ValueError, match="threshold"):
        L.similar_pairs(new, old, 0)


def test_a_stream_appends_unique_vectors_once(spark, tmp_path):
    source, store, log = (str(tmp_path / n) for n in ("in", "store", "log"))

    def arrive(rows):
        table(spark, rows).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        streams.unique_vectors(stream, store, 0.9, log).awaitTermination()
        held = spark.read.parquet(f"{store}/vectors")
        return sorted(r.vec_id for r in held.collect()), sorted((r.vec_id, r.similar_id) for r in spark.read.parquet(f"{store}/mappings").collect())

    arrive([(1, [1.0, 0.0]), (2, [0.0, 1.0])])
    assert run() == ([1, 2], [])
    assert run() == ([1, 2], [])
    arrive([(3, [1.0, 0.01]), (4, [0.7, 0.7])])
    assert run() == ([1, 2, 4], [(3, 1)])
    for name in ("1", ".1.crc"):  # the batch was written, but not committed
        (tmp_path / "log" / "commits" / name).unlink()
    assert run() == ([1, 2, 4], [(3, 1)])
    arrive([(5, [0.7, 0.71])])
    assert run() == ([1, 2, 4], [(3, 1), (5, 4)])

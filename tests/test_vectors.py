import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.functions import vectors as V
from sieveline.operators import lists
from sieveline.operators import vectors as K


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def random_rows(n, dim=8, seed=0):
    rng = np.random.RandomState(seed)
    return [(i, [float(x) for x in rng.randn(dim)]) for i in range(n)]


@pytest.mark.parametrize("metric", K.METRICS)
def test_knn_is_exact(spark, metric):
    rows = random_rows(60)
    v = table(spark, rows).repartition(5)
    m = np.array([r[1] for r in rows], np.float32).astype(float)
    score = {"cosine": lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b), "ip": lambda a, b: a @ b, "l2": lambda a, b: ((a - b) ** 2).sum()}[metric]
    got = {(r.query_id, r.rn): (r.similar_id, r.score) for r in K.knn(v.where("vec_id < 9"), v, 4, metric, block_rows=4).collect()}
    for q in range(9):
        order = sorted((j for j in range(60) if j != q), key=lambda j: score(m[q], m[j]) * (1 if metric == "l2" else -1))[:4]
        assert [got[q, k + 1][0] for k in range(4)] == order
        assert np.allclose([got[q, k + 1][1] for k in range(4)], [score(m[q], m[j]) for j in order])


def test_bounds_ties_zeros_and_errors(spark):
    v = table(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0]), (5, [0.0, 0.0]), (6, None), (None, [1.0, 0.0])])
    q = v.where("vec_id = 1")
    pairs = lambda df: [(r.similar_id, r.score) for r in df.orderBy("rn").collect()]
    assert pairs(K.knn(q, v, 9, min_similarity=1.0)) == [(2, 1.0), (3, 1.0)]
    assert pairs(K.knn(q, v, 9, min_similarity=1.0, strict=True)) == []
    assert pairs(K.knn(q, v, 9, "l2", max_distance=1.0)) == [(2, 0.0), (3, 1.0), (5, 1.0)]
    assert pairs(K.knn(q, v, 1, exclude_self=False)) == [(1, 1.0)]
    assert K.knn(v.limit(0), v, 3).collect() == [] and K.knn(q, v.limit(0), 3).collect() == []
    for bad in ({"metric": "l1"}, {"metric": "l2", "min_similarity": 0.5}, {"max_distance": 1.0}):
        with pytest.raises(ValueError):
            K.knn(q, v, 1, **bad)
    with pytest.raises(Exception, match="different sizes"):
        K.knn(q, table(spark, [(9, [1.0])]), 1).collect()


def test_relevance(spark):
    v = table(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [1.0, 0.2]), (4, [-1.0, 0.0])]).withColumn("label", F.col("vec_id") * 2)
    q = v.where("vec_id in (1, 4)")
    got = {r.query_id: r.relevance for r in K.relevance(K.knn(q, v, 2, min_similarity=0.5), v, "vec_id", "label", q, "vec_id").collect()}
    assert got == {1: 5.0, 4: -1.0}


def test_new_against_stored(spark):
    old = table(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])]).withColumn("key", F.concat(F.lit("k"), "vec_id"))
    new = table(spark, [(10, [1.0, 0.01]), (11, [0.7, 0.7]), (12, [0.0, 1.0]), (13, [0.7, 0.71])]).withColumn("key", F.when(F.col("vec_id") == 12, "k2").otherwise(F.concat(F.lit("n"), "vec_id")))
    flag = lambda compat: {r.vec_id: r.is_duplicate for r in lists.flag_new(new, old, 0.9, compat=compat, content_col="key").collect()}
    assert flag(False) == {10: True, 11: False, 12: True, 13: False}
    assert flag(True) == {10: True, 11: False, 12: False, 13: False}  # a stored copy of itself counts as itself


def test_expressions(spark):
    row = lambda c: spark.createDataFrame([([1.0, 0.0], [0.0, 2.0], [0.0, 0.0], [1.0])], "a array<float>, b array<float>, z array<float>, s array<float>").select(c.alias("x")).first().x
    a, b, z, s = map(F.col, "abzs")
    assert row(V.cosine(a, a)) == 1.0 and row(V.cosine(a, b)) == 0.0 and row(V.cosine(a, z)) == 0.0
    assert row(V.squared_l2(a, b)) == 5.0 and row(V.normalized(b)) == [0.0, 1.0] and row(V.normalized(z)) == [0.0, 0.0]
    with pytest.raises(Exception, match="different sizes"):
        row(V.cosine(a, s))


def test_collection_by_day(spark, tmp_path):
    c = K.Collection(spark, str(tmp_path / "v"))
    for day, n in (("2024-01-01", 2), ("2024-01-03", 3)):
        c.insert(spark.range(n).selectExpr("cast(id as string) item_id", "array(cast(1 as float)) embedding", f"date'{day}' ds"))
    assert c.day("2024-01-03").count() == 3 and c.day("2024-01-04").count() == 3 and c.day("2024-01-04", fallback=False).count() == 0
    assert [str(r.ds) for r in c.expired("2024-01-04").collect()] == ["2024-01-01"]
    assert {r.n: r.dim for r in c.stats().collect()} == {2: 1, 3: 1}


def test_rounding_keeps_the_sign_of_zero(spark):
    rows = [(i, [x]) for i, x in enumerate([-3e-7, 3e-7, -0.0, 0.0, 0.25, -0.1234565, float("nan")])]
    v = table(spark, rows).select("vec_id", F.transform("embedding", lambda x: V.rounded(x.cast("double")))[0].alias("r")).orderBy("vec_id")
    got = [str(r.r) for r in v.collect()]
    assert got == ["-0.0", "0.0", "-0.0", "0.0", "0.25", "-0.123457", "nan"]


def test_normalized_query_rounds_as_its_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from sieveline.plans import catalog

    rows = [(1, [1.0, -3e-7, 3e-7]), (2, [-0.6, 0.8, -0.0])]
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: [str(x) for x in r.unit] for r in catalog.queries()["l2_normalize"](spark, str(tmp_path)).collect()}
    own = duckdb.connect()
    own.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = {k: [str(x) for x in v] for k, v in own.execute(catalog.oracle_sql()["l2_normalize"]).fetchall()}
    assert got == want and "-0.0" in got[1]

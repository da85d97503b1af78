"""The engine's operators as queries over the input tables, each with its SQL.

documents stand for articles and pages, embeddings (with ``label``) for rated vectors, labels for
ratings and the seen-set, events for edits of pages and writes of state, conversations for notes
and benchmark for ground truth. Searches take every vector whose id is divisible by 100 as a query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import records as R
from sieveline.functions import text as X
from sieveline.functions import urls as U
from sieveline.functions import vectors as V
from sieveline.operators import chunking, containment, dedup, evaluate, lists, providers, render, scoring, state
from sieveline.operators import vectors as K
from sieveline.plans import pipelines
from sieveline.session import table as read
from sieveline.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
RUN_DAY = "2024-01-20"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _searched(vectors: DataFrame) -> DataFrame:
    return vectors.where("vec_id % 100 = 0")


_Q = "q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS a, label AS own FROM embeddings WHERE vec_id % 100 = 0), v AS (SELECT vec_id AS similar_id, CAST(embedding AS DOUBLE[]) AS b, label FROM embeddings)"
_COS = f"{_Q}, s AS (SELECT query_id, similar_id, own, label, list_cosine_similarity(a, b) AS sim FROM q, v WHERE query_id <> similar_id), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, similar_id) AS rn FROM s)"


# --- vectors -------------------------------------------------------------------------------


@query(f"""WITH {_COS}, r AS (SELECT q.query_id, coalesce(avg(k.label), -1) AS relevance FROM q LEFT JOIN k ON k.query_id = q.query_id AND rn <= 2 GROUP BY 1)
SELECT query_id, round(relevance, 6) AS relevance FROM r WHERE relevance < 0 OR relevance >= 4 ORDER BY r.relevance DESC, query_id LIMIT 10""")
def relevance_topk(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    q = _searched(v)
    scored = K.relevance(K.knn(q, v, 2), v, "vec_id", "label", q, "vec_id")
    out = scoring.filter_top(scored, "relevance", "query_id", 10, 4.0)
    return out.select("query_id", F.round("relevance", 6).alias("relevance"))


def _neighbours(found: DataFrame) -> DataFrame:
    return found.select("query_id", "similar_id", F.round("score", 6).alias("score"), "rn")


@query(f"WITH {_COS} SELECT query_id, similar_id, round(sim, 6) AS score, CAST(rn AS INTEGER) AS rn FROM k WHERE rn <= 5")
def cosine_knn(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return _neighbours(K.knn(_searched(v), v, 5))


@query(f"""WITH {_Q}, s AS (SELECT query_id, similar_id, list_distance(a, b) ** 2 AS d FROM q, v WHERE query_id <> similar_id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, similar_id) AS rn FROM s WHERE d <= 1.6)
SELECT query_id, similar_id, round(d, 6) AS score, CAST(rn AS INTEGER) AS rn FROM k WHERE rn <= 5""")
def l2_knn(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return _neighbours(K.knn(_searched(v), v, 5, "l2", max_distance=1.6))


@query(f"""WITH {_Q}, s AS (SELECT query_id, similar_id, list_dot_product(a, b) AS d FROM q, v WHERE query_id <> similar_id),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d DESC, similar_id) AS rn FROM s WHERE d >= 0.2)
SELECT query_id, similar_id, round(d, 6) AS score, CAST(rn AS INTEGER) AS rn FROM k WHERE rn <= 5""")
def ip_knn(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return _neighbours(K.knn(_searched(v), v, 5, "ip", min_similarity=0.2))


@query("""SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 6)) AS unit FROM embeddings""")
def l2_normalize(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", F.transform(V.normalized(F.col("embedding")), lambda x: V.rounded(x)).alias("unit"))


@query("""SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS cosine,
round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) ** 2, 6) AS squared_l2 FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def vector_metrics(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    a, b = F.col("embedding"), F.col("b")
    return v.join(after, "vec_id").select("vec_id", V.rounded(V.cosine(a, b)).alias("cosine"), F.round(V.squared_l2(a, b), 6).alias("squared_l2"))


@query(f"""WITH {_COS} SELECT query_id, list(similar_id ORDER BY rn) AS similar_ids, count(*) AS n FROM k WHERE rn <= 5 AND sim >= 0.3 GROUP BY query_id""")
def knn_threshold_dups(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    found = K.knn(_searched(v), v, 5, min_similarity=0.3)
    each = found.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rn", "similar_id"))).alias("s"), F.count("*").alias("n"))
    return each.select("query_id", F.transform("s", lambda x: x.similar_id).alias("similar_ids"), "n")


_NEW = """WITH n AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a FROM embeddings WHERE vec_id % 100 = 0), e AS (SELECT CAST(embedding AS DOUBLE[]) AS b FROM embeddings WHERE vec_id % 100 <> 0),
m AS (SELECT vec_id, max(list_cosine_similarity(a, b)) AS best FROM n, e GROUP BY 1) SELECT vec_id FROM m WHERE """


def _split(spark, sf_dir, compat=False):
    v = read(spark, sf_dir, "embeddings").withColumn("key", F.sha2(F.to_json("embedding"), 256))
    return lists.flag_new(_searched(v), v.where("vec_id % 100 <> 0"), 0.375, compat=compat, content_col="key")


@query(_NEW + "best < 0.375")
def incremental_dedup_unique(spark, sf_dir):
    return _split(spark, sf_dir).where("not is_duplicate").select("vec_id")


@query(_NEW + "best >= 0.375")
def incremental_dedup_dups(spark, sf_dir):
    return _split(spark, sf_dir).where("is_duplicate").select("vec_id")


@query(_NEW + "best < 0.375")
def incremental_dedup_compat(spark, sf_dir):
    return _split(spark, sf_dir, True).where("not is_duplicate").select("vec_id")


@query(f"""WITH {_Q}, s AS (SELECT query_id, similar_id, label, list_distance(a, b) ** 2 AS d FROM q, v),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, similar_id) AS rn FROM s WHERE d <= 1.7),
r AS (SELECT q.query_id, own, coalesce(avg(k.label), -1) AS relevance FROM q LEFT JOIN k ON k.query_id = q.query_id AND rn <= 4 AND k.similar_id <> q.query_id GROUP BY ALL)
SELECT query_id, round(relevance, 6) AS relevance, round(0.8 * own + 0.2 * relevance, 6) AS blended FROM r WHERE round(0.8 * own + 0.2 * relevance, 9) >= 4.5 ORDER BY r.relevance DESC, query_id LIMIT 10""")
def weekly_scored(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    q = _searched(v)
    # the item itself is among the four and leaves after the cut
    hits = K.knn(q, v, 4, "l2", max_distance=1.7, exclude_self=False).where("query_id <> similar_id")
    scored = K.relevance(hits, v, "vec_id", "label", q, "vec_id").join(q.select(F.col("vec_id").alias("query_id"), F.col("label").cast("double").alias("own")), "query_id")
    out = scoring.weekly_filter(scored, "own", "relevance", "query_id")
    return out.select("query_id", F.round("relevance", 6).alias("relevance"), F.round("blended", 6).alias("blended"))


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS ds, count(*) AS n FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20' - 3 GROUP BY 1")
def vector_retention(spark, sf_dir):
    from sieveline.session import shared_path

    c = K.Collection(spark, shared_path(spark, "collection"))
    c.create()
    c.insert(read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("item_id"), F.array(F.col("value").cast("float")).alias("embedding"), F.to_date("ts").alias("ds")))
    return c.stats().join(c.expired(RUN_DAY), "ds").select(F.col("ds").cast("string").alias("ds"), "n")


@query("SELECT 'news_' || regexp_replace(source, '\\W+', '_', 'g') || '__' || '2024_01_20' AS name, count(*) AS n FROM documents GROUP BY 1")
def collection_names(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.groupBy(X.collection_name(F.col("source"), F.lit(RUN_DAY)).alias("name")).agg(F.count("*").alias("n"))


@query("SELECT q.vec_id AS query_id, round(coalesce(avg(e.label), -1), 6) AS relevance FROM embeddings q LEFT JOIN embeddings e ON e.vec_id IN (q.vec_id + 1, q.vec_id + 7) WHERE q.vec_id % 100 = 0 GROUP BY 1")
def metadata_lookup_join(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    q = _searched(v)
    hits = q.select(F.col("vec_id").alias("query_id"), F.explode(F.array(F.col("vec_id") + 1, F.col("vec_id") + 7)).alias("similar_id"))
    return K.relevance(hits, v, "vec_id", "label", q, "vec_id").withColumn("relevance", F.round("relevance", 6))


# --- exact deduplication, state and merging --------------------------------------------------


@query("SELECT sha256(text) AS content_hash, min(doc_id) AS original, count(*) AS copies FROM documents GROUP BY 1")
def exact_dedup_sha256(spark, sf_dir):
    return dedup.first_of_content(read(spark, sf_dir, "documents"), F.col("text"), "doc_id")


@query("SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)")
def first_seen_original(spark, sf_dir):
    return dedup.first_rows(read(spark, sf_dir, "documents"), F.col("text"), "doc_id").select("doc_id", "source", "n_chars")


@query("SELECT min(doc_id) AS cluster_id, count(*) AS size, list_sort(list(DISTINCT source)) AS sources FROM documents GROUP BY text")
def cluster_sources(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return dedup.cluster_sources(d, dedup.star_links(d, F.col("text"), "doc_id"), "doc_id", "source")


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def seen_set_anti_join(spark, sf_dir):
    return dedup.unseen(read(spark, sf_dir, "documents").select("doc_id", "source"), read(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT doc_id FROM documents WHERE lang = 'en' OR doc_id IN (SELECT doc_id FROM labels)")
def seen_set_mark(spark, sf_dir):
    new = read(spark, sf_dir, "documents").where("lang = 'en'")
    return dedup.mark_seen(read(spark, sf_dir, "labels"), new, ["doc_id"])


_SNAPSHOTS = """a AS (SELECT user_id, max(ts) AS edited, arg_max(round(value), ts) AS rating FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY 1),
b AS (SELECT user_id, max(ts) AS edited, arg_max(round(value), ts) AS rating FROM events WHERE ts < TIMESTAMP '2024-01-05' AND event_type = 'purchase' GROUP BY 1)"""


def _snapshot(events: DataFrame, until: str) -> DataFrame:
    own = events.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return own.groupBy("user_id").agg(F.max("ts").alias("edited"), F.round(F.max_by("value", "ts")).alias("rating"))


@query(f"WITH {_SNAPSHOTS} SELECT a.user_id, a.edited FROM a LEFT JOIN b ON a.user_id = b.user_id AND a.edited = b.edited WHERE b.user_id IS NULL")
def version_anti_join(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return dedup.unseen_versions(_snapshot(e, "2024-01-20"), _snapshot(e.where("event_type = 'purchase'"), "2024-01-05"), "user_id", "edited").select("user_id", "edited")


@query(f"WITH {_SNAPSHOTS} SELECT a.user_id FROM a WHERE a.user_id NOT IN (SELECT user_id FROM b)")
def once_only_anti_join(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return dedup.unseen(_snapshot(e, "2024-01-20"), _snapshot(e.where("event_type = 'purchase'"), "2024-01-05"), ["user_id"]).select("user_id")


@query(f"""WITH {_SNAPSHOTS} SELECT a.user_id, a.rating, CASE WHEN b.user_id IS NULL THEN 'new' ELSE 'updated' END AS change_type
FROM a LEFT JOIN b ON a.user_id = b.user_id WHERE b.user_id IS NULL OR a.rating IS DISTINCT FROM b.rating""")
def cdc_new_updated_split(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return dedup.split_changes(_snapshot(e, "2024-01-20"), _snapshot(e.where("event_type = 'purchase'"), "2024-01-05"), "user_id", "rating").select("user_id", "rating", "change_type")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN 'q' || l.quality ELSE substr(d.text, 1, 20) END AS value, l.doc_id IS NOT NULL AS cached FROM documents d LEFT JOIN labels l USING (doc_id)""")
def cache_aside(spark, sf_dir):
    cache = read(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("value"))
    return state.cache_aside(read(spark, sf_dir, "documents").select("doc_id", "text"), cache, "doc_id", X.truncate(F.col("text"), 20)).select("doc_id", "value", "cached")


@query("SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts) AS ts FROM events GROUP BY 1")
def latest_wins(spark, sf_dir):
    return dedup.latest(read(spark, sf_dir, "events").select("user_id", "event_id", "ts"), "user_id", "ts", "event_id").select("user_id", "event_id", "ts")


@query("SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY 1")
def last_source_wins(spark, sf_dir):
    return dedup.last_loaded(read(spark, sf_dir, "events").select("user_id", "event_type", "event_id"), "user_id", "event_id").select("user_id", "event_type", "event_id")


_MARKS = "m AS (SELECT event_type, max(ts) AS watermark FROM events WHERE ts <= TIMESTAMP '2024-01-15' AND event_type <> 'view' GROUP BY 1)"


def _marks(events: DataFrame) -> DataFrame:
    own = events.where((F.col("ts") <= F.lit("2024-01-15").cast("timestamp_ntz")) & (F.col("event_type") != "view"))
    return own.groupBy("event_type").agg(F.max("ts").alias("watermark"))


@query(f"WITH {_MARKS} SELECT e.event_type, count(*) AS n, min(ts) AS first FROM events e LEFT JOIN m USING (event_type) WHERE watermark IS NULL OR ts >= watermark GROUP BY 1")
def watermark_inclusive(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", "ts")
    return state.since(e, _marks(e), "event_type", "ts").groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first"))


@query(f"WITH {_MARKS} SELECT e.event_type, count(*) AS n, min(ts) AS first FROM events e LEFT JOIN m USING (event_type) WHERE watermark IS NULL OR ts > watermark GROUP BY 1")
def watermark_strict(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", "ts")
    return state.since(e, _marks(e), "event_type", "ts", strict=True).groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first"))


@query("SELECT event_type, max(ts) AS watermark FROM events GROUP BY 1")
def watermark_advance(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", "ts")
    return state.advance(_marks(e), e.where(F.col("ts") > F.lit("2024-01-10").cast("timestamp_ntz")), "event_type", "ts").select("event_type", "watermark")


def _state(spark, sf_dir, ttl: int, overwrite: bool) -> DataFrame:
    e = read(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("event_type").alias("value"), F.lit(ttl).alias("ttl_seconds"), F.col("event_id").alias("ord"), "ts")
    day = F.lit("2024-01-10").cast("timestamp_ntz")
    none = spark.createDataFrame([], "key long, value string, expires_at timestamp_ntz")
    before = state.put(none, e.where(F.col("ts") < day), "2024-01-10", overwrite=overwrite)
    return state.put(before, e.where(F.col("ts") >= day), RUN_DAY, overwrite=overwrite).select("key", "value", "expires_at")


@query("SELECT user_id AS key, arg_min(event_type, event_id) AS value, CAST(NULL AS TIMESTAMP) AS expires_at FROM events GROUP BY 1")
def kv_insert_if_absent(spark, sf_dir):
    return _state(spark, sf_dir, 0, False)


@query("SELECT user_id AS key, arg_max(event_type, event_id) AS value, CAST(NULL AS TIMESTAMP) AS expires_at FROM events GROUP BY 1")
def kv_overwrite(spark, sf_dir):
    return _state(spark, sf_dir, 0, True)


@query("SELECT user_id AS key, arg_max(event_type, event_id) AS value, TIMESTAMP '2024-01-20 01:00:00' AS expires_at FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1")
def kv_ttl_expire(spark, sf_dir):
    return state.get(_state(spark, sf_dir, 3600, False), "2024-01-20 00:30:00")


@query("SELECT user_id, ts, event_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' - 7 AND CAST(ts AS DATE) <= DATE '2024-01-20' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1")
def trailing_snapshot(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("user_id", "ts", "event_id").withColumn("ds", F.to_date("ts"))
    return dedup.latest(files.trailing_days(e, "ds", RUN_DAY, 7).drop("ds"), "user_id", "ts", "event_id").select("user_id", "ts", "event_id")


@query("SELECT event_id AS order_id, event_type AS name FROM events WHERE event_type = 'signup' AND event_id NOT IN (SELECT doc_id FROM labels)")
def pending_patches(spark, sf_dir):
    p = read(spark, sf_dir, "events").where("event_type = 'signup'").select(F.col("event_id").alias("order_id"), F.col("event_type").alias("name"))
    return state.pending_patches(p, read(spark, sf_dir, "labels").select(F.col("doc_id").alias("order_id")))


# --- filters and rankings ---------------------------------------------------------------------

_SCORED = "SELECT doc_id, source, coalesce(quality * 5 - toxic, -1) AS score FROM documents LEFT JOIN labels USING (doc_id)"


def _scored(spark, sf_dir):
    score = F.coalesce(F.col("quality") * 5 - F.col("toxic"), F.lit(-1))
    return read(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(read(spark, sf_dir, "labels"), "doc_id", "left").withColumn("score", score).drop("quality", "toxic")


@query(f"WITH s AS ({_SCORED}) SELECT doc_id, score FROM s WHERE score < 0 OR score >= 4 ORDER BY score DESC, doc_id LIMIT 25")
def cold_start_filter(spark, sf_dir):
    return scoring.filter_top(_scored(spark, sf_dir), "score", "doc_id", 25, 4.0).select("doc_id", "score")


@query(f"WITH s AS ({_SCORED}) SELECT doc_id, source, score FROM s WHERE score < 0 OR score >= CASE source WHEN 'src1' THEN 4.5 WHEN 'src2' THEN 5 ELSE 3.5 END")
def per_list_threshold(spark, sf_dir):
    parsed = spark.range(1).select(F.explode(R.thresholds(F.lit("src1:4.5,src2:5,src3:0,broken,src4:x"))).alias("list_name", "min_score"))
    return scoring.filter_by_list(_scored(spark, sf_dir), parsed, "source", "score", 3.5).select("doc_id", "source", "score")


@query("SELECT source, doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS INTEGER) AS rn FROM documents QUALIFY rn <= 3")
def first_n_per_feed(spark, sf_dir):
    return dedup.first_n(read(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 3)


@query("SELECT source, doc_id, CAST(floor((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) / 100) AS BIGINT) AS batch FROM documents")
def batch_numbers(spark, sf_dir):
    return chunking.batch_numbers(read(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 100)


def _pages(spark, sf_dir):
    """Documents as rated pages: five stars for good ones, take-aways on English ones, two tags each."""
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return d.select(
        F.col("doc_id").cast("string").alias("item_id"), F.col("doc_id").alias("ordinal"), "source", (F.col("quality") * 5).cast("double").alias("user_rating"),
        F.when(F.col("lang") == "en", F.col("text")).otherwise("").alias("take_aways"),
        F.array(F.col("lang"), F.when(F.col("toxic") == 1, "action:deepdive").otherwise("t")).alias("tags"), F.lit(RUN_DAY).cast("timestamp").alias("last_edited_time"), "text",
    )


_PAGES = """p AS (SELECT d.doc_id, d.source, d.lang, d.text, CAST(quality * 5 AS DOUBLE) AS user_rating, CASE WHEN lang = 'en' THEN text ELSE '' END AS take_aways, coalesce(toxic, 0) = 1 AS deep
FROM documents d LEFT JOIN labels USING (doc_id))"""


@query(f"""WITH {_PAGES}, r AS (SELECT p.*, coalesce(CAST(e.label AS DOUBLE), -1) AS relevance FROM p LEFT JOIN embeddings e ON e.vec_id = p.doc_id WHERE user_rating >= 4 OR take_aways <> '')
SELECT CAST(doc_id AS VARCHAR) AS item_id, user_rating, relevance, round(0.8 * user_rating + 0.2 * relevance, 6) AS blended FROM r WHERE 0.8 * user_rating + 0.2 * relevance >= 4 ORDER BY relevance DESC, doc_id LIMIT 40""")
def takeaway_filter(spark, sf_dir):
    relevance = read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("item_id"), F.col("label").cast("double").alias("relevance"))
    return pipelines.weekly(_pages(spark, sf_dir), relevance, 40, post=4.0).select("item_id", "user_rating", "relevance", F.round("blended", 6).alias("blended"))


@query(f"WITH {_PAGES} SELECT CAST(doc_id AS VARCHAR) AS item_id, source FROM p WHERE take_aways <> '' AND source <> 'TODO' AND NOT deep AND doc_id % 3 <> 0")
def exclude_tags(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    seen = pages.where("ordinal % 3 = 0").select("item_id", "last_edited_time")
    return pipelines.todos(pages, seen).select("item_id", "source")


@query(f"""WITH s AS ({_SCORED}), t AS (SELECT s.*, length(text) AS n FROM s JOIN documents USING (doc_id)) SELECT doc_id, (score > 0 AND score < 4) OR n > 2000 AS skipped FROM t""")
def rank_skip(spark, sf_dir):
    rows = _scored(spark, sf_dir).join(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return rows.select("doc_id", scoring.rank_skip(F.col("score"), F.col("text"), True, 4.0).alias("skipped"))


@query("""SELECT event_type, CASE WHEN r <= 0.5 THEN '<=0.5' WHEN r <= 0.6 THEN '<=0.6' WHEN r <= 0.7 THEN '<=0.7' WHEN r <= 0.8 THEN '<=0.8' WHEN r <= 0.9 THEN '<=0.9' ELSE '<=1.0' END AS bucket, count(*) AS n
FROM (SELECT event_type, value / 100 AS r FROM events) WHERE r <= 1 GROUP BY ALL""")
def rating_histogram(spark, sf_dir):
    return scoring.histogram(read(spark, sf_dir, "events"), "event_type", F.col("value") / 100)


@query("""SELECT source, count(*) AS input, CAST(count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS BIGINT) AS deduped, CAST(count(*) FILTER (length(text) >= 1000) AS BIGINT) AS long FROM documents GROUP BY 1""")
def stage_stats(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    fresh = dedup.unseen(d.select("doc_id", "source"), read(spark, sf_dir, "labels"), ["doc_id"])
    return scoring.stage_counts({"input": d, "deduped": fresh, "long": d.where(F.length("text") >= 1000)}, "source")


@query("SELECT source, count(*) AS n, count(*) - count(DISTINCT text) AS duplicates, round(1 - count(DISTINCT text) / count(*), 6) AS dedup_rate FROM documents GROUP BY 1")
def dedup_rate(spark, sf_dir):
    rates = evaluate.dedup_rates(read(spark, sf_dir, "documents"), "source", F.col("text"))
    return rates.withColumn("dedup_rate", F.round("dedup_rate", 6))


# --- evaluation -------------------------------------------------------------------------------

_TOKENS = r"list_distinct(list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda t: t <> ''))"
_OVERLAP = f"""t AS (SELECT doc_id, {_TOKENS} AS a FROM documents), g AS (SELECT item_id, {_TOKENS} AS b FROM benchmark),
p AS (SELECT doc_id, item_id, CASE WHEN least(len(a), len(b)) > 0 THEN len(list_intersect(a, b)) / least(len(a), len(b)) ELSE 0 END AS overlap FROM t, g),
o AS (SELECT doc_id, arg_max(item_id, (overlap, -item_id)) AS item_id, max(overlap) AS overlap FROM p GROUP BY 1)"""


def _overlap(spark, sf_dir):
    return containment.best_containment(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), "doc_id", "item_id")


@query(f"WITH {_OVERLAP} SELECT doc_id, item_id, round(overlap, 6) AS overlap FROM o")
def text_containment(spark, sf_dir):
    return _overlap(spark, sf_dir).withColumn("overlap", F.round("overlap", 6))


_RATES = """round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if c in ("precision", "recall", "f1", "accuracy") else F.col(c) for c in df.columns))


@query(f"""WITH {_OVERLAP}, c AS (SELECT lang, CAST(count(*) FILTER (k AND t) AS DOUBLE) AS tp, CAST(count(*) FILTER (k AND NOT t) AS DOUBLE) AS fp, CAST(count(*) FILTER (NOT k AND t) AS DOUBLE) AS fn, CAST(count(*) FILTER (NOT k AND NOT t) AS DOUBLE) AS tn
FROM (SELECT lang, doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text) AS k, overlap >= 0.3 AS t FROM o JOIN documents USING (doc_id)) GROUP BY 1) SELECT lang, tp, fp, fn, tn, {_RATES} FROM c""")
def eval_confusion(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    kept = dedup.first_rows(d, F.col("text"), "doc_id").select("doc_id", F.lit(True).alias("kept"))
    rows = _overlap(spark, sf_dir).join(d.select("doc_id", "lang"), "doc_id").join(kept, "doc_id", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    return _rounded(evaluate.evaluate_kept(rows, "kept", "overlap", by=["lang"]))


@query(f"""WITH {_OVERLAP}, c AS (SELECT threshold, CAST(count(*) FILTER (k AND t) AS DOUBLE) AS tp, CAST(count(*) FILTER (k AND NOT t) AS DOUBLE) AS fp, CAST(count(*) FILTER (NOT k AND t) AS DOUBLE) AS fn, CAST(count(*) FILTER (NOT k AND NOT t) AS DOUBLE) AS tn
FROM (SELECT threshold, overlap >= threshold AS k, quality = 1 AS t FROM o JOIN labels USING (doc_id), (VALUES (0.85), (0.9), (0.95)) x(threshold)) GROUP BY 1) SELECT CAST(threshold AS DOUBLE) AS threshold, tp, fp, fn, tn, {_RATES} FROM c""")
def threshold_sweep(spark, sf_dir):
    # pairs below the lowest threshold count for nothing, so the index is enough
    thresholds, d = [0.85, 0.90, 0.95], read(spark, sf_dir, "documents")
    found = containment.containing(d, read(spark, sf_dir, "benchmark"), "doc_id", "item_id", threshold=thresholds[0]).groupBy("doc_id").agg(F.max("overlap").alias("overlap"))
    rows = read(spark, sf_dir, "labels").join(d.select("doc_id"), "doc_id").join(found, "doc_id", "left")
    rows = rows.select("doc_id", F.coalesce("overlap", F.lit(0.0)).alias("overlap"), (F.col("quality") == 1).alias("good"))
    return _rounded(evaluate.sweep(rows, "overlap", "good", thresholds))


# --- text, keys, dates ------------------------------------------------------------------------


@query()
def chunk_documents(spark, sf_dir):
    return chunking.chunk(read(spark, sf_dir, "documents"))


@query()
def chunk_default_separators(spark, sf_dir):
    return chunking.chunk(read(spark, sf_dir, "documents"), size=2048, overlap=256, separators=chunking.PLAIN)


@query()
def chunk_statistics(spark, sf_dir):
    return chunking.statistics(chunking.chunk(read(spark, sf_dir, "documents")))


@query("SELECT lang, CAST(sum(length(text) // 4) AS BIGINT) AS tokens, round(sum(length(text) // 4) / 1e6 * 0.02 * 100, 9) AS cost_cents, round(sum(length(text) // 4) / 1e6 * 0.02, 9) AS cost_dollars FROM documents GROUP BY 1")
def token_cost_estimate(spark, sf_dir):
    t = read(spark, sf_dir, "documents").groupBy("lang").agg(F.sum(X.estimate_tokens(F.col("text"))).alias("tokens"))
    cents = X.token_cost_cents(F.col("tokens"))
    return t.select("lang", "tokens", F.round(cents, 9).alias("cost_cents"), F.round(cents / 100, 9).alias("cost_dollars"))


@query("SELECT doc_id, sha256(text) AS chunk_key, md5(text) AS text_key, md5(source || '_' || lang || '_' || '2024-01-20') AS feed_key FROM documents")
def surrogate_keys_md5(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", R.content_id(F.col("text")).alias("chunk_key"), F.md5("text").alias("text_key"), R.surrogate_key(F.col("source"), F.col("lang"), F.lit(RUN_DAY)).alias("feed_key"))


@query(r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, '\n+', chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS refined FROM documents")
def refine_whitespace(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(X.refine(F.col("text"))).alias("refined"))


@query("SELECT doc_id, substr(text, 1, 20) AS label, substr(text, 1, 200) AS short, md5(substr(text, 1, 1024)) AS embed_key, length(substr(text, 1, 5000)) AS n FROM documents")
def truncate_text(spark, sf_dir):
    t = F.col("text")
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", X.truncate(t, 20).alias("label"), X.truncate(t, 200).alias("short"), F.md5(X.truncate(t, 1024)).alias("embed_key"), F.length(X.truncate(t, 5000)).cast("long").alias("n"))


@query("SELECT conv_id, turn, CASE WHEN prev IS NOT NULL THEN prev || ': ' ELSE '' END || role || ': ' || text AS ranking_text FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations)")
def ranking_text(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    before = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("prev"))
    text = F.concat(F.when(F.col("prev").isNotNull(), F.concat("prev", F.lit(": "))).otherwise(F.lit("")), "role", F.lit(": "), "text")
    return c.join(before, ["conv_id", "turn"], "left").select("conv_id", "turn", text.alias("ranking_text"))


_STRIP = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_REST = f"list_aggregate(list_transform({{}}[2:], lambda p: {_STRIP.format('p')} || chr(10)), 'string_agg', '')"


@query(f"""WITH t AS (SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN replace(text, chr(10), chr(10) || chr(10)) WHEN 2 THEN replace(text, chr(10), '===')
  WHEN 3 THEN replace(replace(text, chr(10), chr(10) || chr(10)), ', ', '===') WHEN 4 THEN '' ELSE text END AS x FROM documents),
m AS (SELECT doc_id, x, string_split(x, '===') AS parts FROM t), b AS (SELECT *, string_split({_STRIP.format('parts[1]')}, chr(10) || chr(10)) AS blocks FROM m)
SELECT doc_id, CASE WHEN x = '' THEN x ELSE {_STRIP.format('blocks[1]')} END AS summary, coalesce(CASE WHEN len(blocks) > 1 THEN {_REST.format('blocks')} ELSE {_REST.format('parts')} END, '') AS translation FROM b""")
def split_summary_translation(spark, sf_dir):
    # texts as they are, with blank lines, with marks, with both, and empty
    text, lines = F.col("text"), F.replace("text", F.lit("\n"), F.lit("\n\n"))
    kinds = [text, lines, F.replace("text", F.lit("\n"), F.lit("===")), F.replace(lines, F.lit(", "), F.lit("===")), F.when(text.isNotNull(), "")]
    own = F.coalesce(*(F.when(F.col("doc_id") % 5 == k, x) for k, x in enumerate(kinds)))
    parts = X.split_summary(own)
    return read(spark, sf_dir, "documents").select("doc_id", parts["summary"].alias("summary"), parts["translation"].alias("translation"))


@query()
def pack_text_blocks(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return d.select("doc_id", X.pack_sentences(F.col("text")).alias("sentences"), X.pack_lines(F.col("text")).alias("lines"))


@query("SELECT conv_id, turn, i - 1 AS pos, item FROM (SELECT conv_id, turn, generate_subscripts(x, 1) AS i, unnest(x) AS item FROM (SELECT conv_id, turn, list_filter(list_transform(string_split(text, chr(10)), lambda s: trim(regexp_replace(s, '^\\s*\\d+\\.\\s*', ''), ' ')), lambda s: s <> '') AS x FROM conversations WHERE role = 'user'))")
def todo_explode(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").where("role = 'user'")
    each = c.select("conv_id", "turn", F.posexplode(X.todo_items(F.col("text"))).alias("pos", "item"))
    return each.select("conv_id", "turn", F.col("pos").cast("long").alias("pos"), "item")


@query(r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'),
  '(?is)<style\b.*?</style\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '"'), '&amp;', '&'), '[ \t\r\n\f]+', ' ', 'g')) AS text FROM pages""")
def html_to_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


@query("""SELECT page_id, contains(url, '/gallery/') AS is_gallery, regexp_matches(url, '[?&](utm_[a-z]+|ref|fbclid|gclid)=') AS has_tracking, regexp_matches(lower(regexp_replace(url, '[?#].*$', '')), '\\.(jpg|jpeg|png|gif|webp)$') AS is_image FROM pages""")
def url_flags(spark, sf_dir):
    f = U.flags(F.col("url"))
    return read(spark, sf_dir, "pages").select("page_id", *(f[n].alias(n) for n in ("is_gallery", "has_tracking", "is_image")))


@query("""SELECT page_id, lower(regexp_extract(u, '^([a-zA-Z]+://[^/?#]*)', 1)) || substr(u, length(regexp_extract(u, '^([a-zA-Z]+://[^/?#]*)', 1)) + 1) AS url FROM (
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '([?&])(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '\\1', 'g'), '[?&]+$', ''), '/+$', '') AS u FROM pages)""")
def url_normalize(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", U.normalize(F.col("url")).alias("url"))


@query("SELECT lower(regexp_extract(url, '://([^/?#]*)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1")
def url_hosts(spark, sf_dir):
    return read(spark, sf_dir, "pages").groupBy(U.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query("""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN -0.01 ELSE CAST(json_extract(props, '$.k') AS DOUBLE) / 100 END AS overall_score FROM events""")
def rank_json_parse(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    good = F.concat(F.lit('{"feedback":\t"ok", "topics": [], "overall_score": '), (F.get_json_object("props", "$.k").cast("double") / 100).cast("string"), F.lit("}"))
    answer = F.when(F.col("event_id") % 10 == 0, F.lit("{broken")).otherwise(good)
    return e.select("event_id", R.ranking(answer)["overall_score"].alias("overall_score"))


@query("""SELECT user_id, list_transform(list_slice(list(struct_pack(n := event_type || ',' || event_id, v := value) ORDER BY value DESC, event_id), 1, 3), lambda x: substr(replace(x.n, ',', ' '), 1, 20)) AS topics FROM events GROUP BY 1""")
def topic_topk_clean(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    # three a user leave each task: top-k before the pairs are gathered
    best = dedup.first_n(e.withColumn("o", F.struct((-F.col("value")).alias("v"), "event_id")), "user_id", "o", 3)
    pair = F.struct("rn", F.struct(F.concat_ws(",", "event_type", "event_id").alias("name"), F.col("value").alias("score")).alias("p"))
    pairs = F.transform(F.array_sort(F.collect_list(pair)), lambda x: x.p)
    return best.groupBy("user_id").agg(R.labels(R.top_pairs(pairs, 3)).alias("topics"))


@query("""SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Los_Angeles', '%Y-%m-%d %H:%M:%S') AS pacific FROM events""")
def iso_parse_to_pacific(spark, sf_dir):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return read(spark, sf_dir, "events").select("event_id", F.date_format(R.pacific(R.parse_iso(iso).cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss").alias("pacific"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, CAST(count(*) FILTER (isodow(ts) = 6) AS BIGINT) AS saturday FROM events GROUP BY 1")
def date_key(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(R.date_key(F.col("ts"), RUN_DAY).alias("day"), (F.weekday("ts") == 5).alias("s"))
    return e.groupBy("day").agg(F.count("*").alias("n"), F.count_if("s").alias("saturday"))


@query("SELECT event_id, round(0.8 * value + 0.2 * (event_id % 5), 6) AS blended, round(coalesce(nullif(event_id % 3, 0), -1), 6) AS rate FROM events")
def score_arithmetic(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select("event_id", F.round(R.blended(F.col("value"), F.col("event_id") % 5), 6).alias("blended"), F.round(R.falsy((F.col("event_id") % 3).cast("double"), -1.0), 6).alias("rate"))


@query("SELECT conv_id, string_agg(role || ' ' || text || chr(10), '' ORDER BY turn) AS entry, count(*) AS n, max(turn) AS last_created_time FROM conversations GROUP BY 1")
def journal_concat(spark, sf_dir):
    return render.journal(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text", "turn")


@query("""WITH s AS (SELECT d.doc_id, source, lang, text AS title, row_number() OVER (PARTITION BY source ORDER BY d.doc_id) AS rn FROM documents d JOIN labels l ON d.doc_id = l.doc_id AND quality = 1)
SELECT source, list(title ORDER BY doc_id) AS titles, list_sort(list(DISTINCT lang)) AS topics, count(*) AS n FROM s WHERE rn <= 10 GROUP BY 1""")
def weekly_collection_grouped(spark, sf_dir):
    good = read(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    d = read(spark, sf_dir, "documents").join(good, "doc_id").select("doc_id", "source", F.array("lang").alias("topics"), F.col("text").alias("title"))
    return render.collection(dedup.first_n(d, "source", "doc_id", 10), "source", "doc_id", "title", "topics")


@query("SELECT category, string_agg(name || '=' || id, ',' ORDER BY name) AS names FROM (SELECT lang AS category, source AS name, CAST(min(doc_id) AS VARCHAR) AS id FROM documents GROUP BY ALL) GROUP BY 1")
def index_pages_map(spark, sf_dir):
    from sieveline.schemas import index_map

    d = read(spark, sf_dir, "documents").groupBy(F.col("lang").alias("category"), F.col("source").alias("name"))
    pairs = F.transform(F.array_sort(F.map_entries("names")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return index_map(d.agg(F.min("doc_id").cast("string").alias("index_id"))).select("category", F.array_join(pairs, ",").alias("names"))


# --- metrics ------------------------------------------------------------------------------------


@query("""WITH s AS (SELECT source, lang, CASE WHEN quality IS NULL THEN 'pending' WHEN quality = 1 THEN 'approved' ELSE 'rejected' END AS status FROM documents LEFT JOIN labels USING (doc_id))
SELECT source, lang, count(*) AS n, CAST(count(*) FILTER (status = 'approved') AS BIGINT) AS approved, round(coalesce(count(*) FILTER (status = 'approved') / nullif(count(*) FILTER (status <> 'pending'), 0), 0), 6) AS approval_rate FROM s GROUP BY ROLLUP (source, lang)""")
def funnel_metrics(spark, sf_dir):
    from sieveline.operators.health import funnel

    status = F.when(F.col("quality").isNull(), "pending").when(F.col("quality") == 1, "approved").otherwise("rejected")
    d = read(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return funnel(d.withColumn("status", status), ["source", "lang"], "status").select("source", "lang", "n", "approved", F.round("approval_rate", 6).alias("approval_rate"))


@query("""WITH h AS (SELECT user_id, ts, event_type = 'error' AS failed, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events),
r AS (SELECT user_id, island, count(*) FILTER (failed) AS run FROM h GROUP BY ALL)
SELECT h.user_id, count(*) AS pulls, round(count(*) FILTER (failed) / count(*), 6) AS failure_rate, max(ts) FILTER (NOT failed) AS last_success, (SELECT max(run) FROM r WHERE r.user_id = h.user_id) >= 3 AS failing FROM h GROUP BY h.user_id""")
def source_health(spark, sf_dir):
    from sieveline.operators.health import source_health as health

    return health(read(spark, sf_dir, "events"), "user_id", "ts", "event_id", F.col("event_type") == "error")


@query("""WITH d AS (SELECT user_id, min(ts) FILTER (event_type = 'signup') AS started, min(ts) FILTER (event_type = 'purchase') AS done FROM events GROUP BY 1)
SELECT user_id, date_diff('day', CAST(started AS DATE), CAST(coalesce(done, TIMESTAMP '2024-01-31') AS DATE)) AS days, coalesce(done IS NULL AND date_diff('day', CAST(started AS DATE), DATE '2024-01-31') > 7, false) AS stuck FROM d WHERE started IS NOT NULL""")
def review_velocity(spark, sf_dir):
    from sieveline.operators.health import review_velocity as velocity

    e = read(spark, sf_dir, "events")
    return velocity(e, "user_id", "ts", F.col("event_type") == "signup", F.col("event_type") == "purchase", "2024-01-31")


# --- streams --------------------------------------------------------------------------------------


def _streamed(spark: SparkSession, sf_dir: str, name: str, apply: Callable[[DataFrame], DataFrame], mode: str) -> DataFrame:
    """What a stream over one table's file gives once it has read all of it, as a table in the shared folder."""
    from sieveline.session import shared_path

    base = read(spark, sf_dir, "events")
    stream = spark.readStream.schema(base.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out = apply(stream)
    path = shared_path(spark, name)
    if mode == "append":
        q = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-log").trigger(availableNow=True).start()
    else:
        def save(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(path)

        q = out.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", f"{path}-log").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(path)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, sf_dir):
    from sieveline.streaming import streams

    return _streamed(spark, sf_dir, "stream-dedup", lambda s: streams.unseen(s.select("user_id", "event_type"), ["user_id", "event_type"]), "append")


@query("SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_daily_window(spark, sf_dir):
    from sieveline.streaming import streams

    def apply(s: DataFrame) -> DataFrame:
        counts = streams.windowed_counts(s.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"])
        return counts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))

    return _streamed(spark, sf_dir, "stream-daily", apply, "complete")


# --- pipelines ------------------------------------------------------------------------------------


def _items(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("item_id"), F.lit("feed").alias("source"), F.col("source").alias("list_name"), F.element_at(F.split("text", "\n"), 1).alias("title"), "text", F.col("doc_id").alias("ordinal")
    )


def _seen(spark, sf_dir):
    return read(spark, sf_dir, "labels").where("toxic = 1").join(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").select(
        F.lit("feed").alias("source"), F.col("source").alias("list_name"), F.col("doc_id").cast("string").alias("item_id")
    )


def _scores(spark, sf_dir):
    """The mean rating of the two nearest vectors of each searched one, for the document of its id; others are unknown."""
    v = read(spark, sf_dir, "embeddings")
    q = _searched(v)
    found = K.relevance(K.knn(q, v, 2), v, "vec_id", "label", q, "vec_id")
    return found.select(F.col("query_id").cast("string").alias("item_id"), "relevance")


def _limits(spark):
    return spark.range(1).select(F.explode(R.thresholds(F.lit("src1:8,src2:9"))).alias("list_name", "min_score"))


_PIPE = f"""{_COS}, r AS (SELECT query_id, avg(label) AS relevance FROM k WHERE rn <= 2 GROUP BY 1),
i AS (SELECT d.doc_id, d.source, d.text, coalesce(r.relevance, -1) AS relevance FROM documents d LEFT JOIN r ON r.query_id = d.doc_id
WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1))"""


@query(f"WITH {_PIPE} SELECT CAST(doc_id AS VARCHAR) AS item_id, relevance, -1.0::DOUBLE AS rate FROM i WHERE relevance < 0 OR relevance >= 4 ORDER BY relevance DESC, doc_id LIMIT 25")
def pipeline_rss(spark, sf_dir):
    return pipelines.rss(_items(spark, sf_dir), _seen(spark, sf_dir), _scores(spark, sf_dir), pipelines.Config(k=25)).select("item_id", "relevance", "rate")


_KEPT = f"{_PIPE}, kept AS (SELECT * FROM i WHERE relevance < 0 OR relevance >= CASE source WHEN 'src1' THEN 8 WHEN 'src2' THEN 9 ELSE 4 END)"


@query(f"WITH {_KEPT} SELECT CAST(doc_id AS VARCHAR) AS item_id, relevance, round(CASE WHEN length(text) > 2000 THEN -2 ELSE least(1, (length(text) // 2) / 1000) * 100 END, 4) AS rate FROM kept")
def pipeline_twitter(spark, sf_dir):
    out = pipelines.twitter(_items(spark, sf_dir), _seen(spark, sf_dir), _scores(spark, sf_dir), _limits(spark))
    return out.select("item_id", "relevance", F.round("rate", 4).alias("rate"))


_W = r"[\x09-\x0D\x20\x1C-\x1F\x{85}\x{A0}]+"
_TRIM = lambda x: f"regexp_replace(regexp_replace({x}, '^{_W}', ''), '{_W}$', '')"
#: The first so many sentences of a text.
_CUT = lambda x, n: f"array_to_string(string_split(regexp_replace({x}, '([.!?])[\\x09-\\x0D\\x20]+', '\\1' || chr(1), 'g'), chr(1))[1:{n}], ' ')"
_LEAD = lambda x: f"CASE WHEN length({x}) <= 200 THEN {x} ELSE {_TRIM(_CUT(f'left({x}, 20000)', 2))} END"
_RANKED = f"least(1, (length(t) // 2) / 1000) AS score, lower(regexp_extract({_TRIM('t')}, '^[^\\x09-\\x0D\\x20]*')) AS topic"


def _topics(df: DataFrame) -> DataFrame:
    """Ranked items with names and scores of their topics as text."""
    pairs = lambda c: F.array_join(F.transform(c, lambda t: F.concat(t["name"], F.lit("="), F.round(t["score"], 4).cast("string"))), ",")
    return df.select("item_id", "title", "summary", *(["relevance"] if "relevance" in df.columns else []), F.round("rate", 4).alias("rate"), pairs("topics").alias("topics"), pairs("categories").alias("categories"))


_AS_TEXT = "CASE WHEN skip THEN '' ELSE topic || '=' || CAST(round(CASE WHEN score = 0 THEN 1 ELSE score END, 4) AS DOUBLE) END AS topics, CASE WHEN skip THEN '' ELSE 'general=' || CAST(round(CASE WHEN score = 0 THEN 1 ELSE score END, 4) AS DOUBLE) END AS categories"


@query(f"""WITH {_KEPT}, m AS (SELECT *, string_split(text, chr(10))[1] AS title, {_LEAD('text')} AS summary FROM kept), n AS (SELECT *, source || ' ' || title || ' ' || summary AS t FROM m),
z AS (SELECT *, {_RANKED}, (relevance > 0 AND relevance < 4) OR length(t) > 2000 AS skip FROM n)
SELECT CAST(doc_id AS VARCHAR) AS item_id, title, summary, relevance, round(CASE WHEN skip THEN -2 ELSE score * 100 END, 4) AS rate, {_AS_TEXT} FROM z""")
def pipeline_reddit(spark, sf_dir):
    return _topics(pipelines.reddit(_items(spark, sf_dir), _seen(spark, sf_dir), _scores(spark, sf_dir), _limits(spark)))


@query(f"""WITH m AS (SELECT doc_id, string_split(text, chr(10))[1] AS title, {_LEAD('text')} AS t FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
r AS (SELECT *, t AS summary, {_RANKED}, length(t) > 2000 AS skip FROM m)
SELECT CAST(doc_id AS VARCHAR) AS item_id, title, summary, round(CASE WHEN skip THEN -0.02 ELSE score END, 4) AS rate, {_AS_TEXT} FROM r""")
def pipeline_article(spark, sf_dir):
    return _topics(pipelines.article(_items(spark, sf_dir), _seen(spark, sf_dir)))


@query()
def hashed_embeddings(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select("item_id", providers.hashed_embedding(F.col("text")).alias("embedding"))


@query(r"""WITH q AS (SELECT item_id, list_distinct(list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda t: t <> '')) AS b FROM benchmark),
d AS (SELECT doc_id, list_distinct(list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda t: t <> '')) AS a FROM documents),
s AS (SELECT item_id, doc_id, len(list_intersect(a, b)) / len(b) AS score FROM q, d WHERE len(b) > 0)
SELECT item_id AS query_id, doc_id, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rn FROM s WHERE score > 0 QUALIFY rn <= 3""")
def text_search(spark, sf_dir):
    from sieveline.operators.search import search

    return search(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents")).withColumn("score", F.round("score", 6))


@query("""WITH a AS (SELECT conv_id, turn, role, text, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'user' AS below FROM conversations),
o AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN text || chr(10) WHEN 'system' THEN text ELSE CASE WHEN coalesce(below, false) THEN list_aggregate(list_transform(string_split(text, ' '), lambda c: c || ','), 'string_agg', '') || chr(10) ELSE '- ' || text || chr(10) END END
  || CASE WHEN role = 'user' AND lead(role) OVER (PARTITION BY conv_id ORDER BY turn) = 'assistant' THEN '' ELSE '|' END AS own FROM a)
SELECT conv_id AS page_id, string_agg(own, '' ORDER BY turn) AS text, count(*) AS n FROM o GROUP BY 1""")
def block_tree_text(spark, sf_dir):
    from sieveline.operators.blocks import page_text

    # answers are table rows below the toggle of the question before them, or bullets of their own
    c = read(spark, sf_dir, "conversations")
    asked = c.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("turn").alias("asked"))
    rows = c.join(asked, ["conv_id", "turn"], "left").withColumn("parent_id", F.when(F.col("role") == "assistant", F.col("asked")))
    kind = F.when(F.col("role") == "user", "toggle").when(F.col("role") == "system", "quote").when(F.col("parent_id").isNotNull(), "table_row").otherwise("bulleted_list_item")
    blocks = rows.select(F.col("conv_id").alias("page_id"), F.col("turn").alias("block_id"), "parent_id", F.col("turn").alias("pos"), kind.alias("type"), "text", F.split("text", " ").alias("cells"))
    return page_text(blocks, "|")

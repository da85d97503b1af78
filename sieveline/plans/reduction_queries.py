"""Keyed streams, summaries by map and reduce, and mergeable sketches as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sieveline.operators import sketches, summaries
from sieveline.operators.numbering import numbered
from sieveline.plans import evaluation
from sieveline.plans.queries import _LEAD, query
from sieveline.session import shared_path
from sieveline.session import table as read
from sieveline.streaming import keyed


@query("""WITH w AS (SELECT user_id, event_id, ts, event_type = 'view' AS lives FROM events),
l AS (SELECT user_id, max(ts) FILTER (lives) + INTERVAL 2 DAYS AS ends, arg_max(event_id, (ts, event_id)) FILTER (lives) AS v FROM w GROUP BY 1),
f AS (SELECT w.user_id, arg_min(event_id, (ts, event_id)) AS v FROM w JOIN l USING (user_id) WHERE NOT lives AND (ends IS NULL OR ts >= ends) GROUP BY 1)
SELECT 'user_' || l.user_id AS key, CAST(coalesce(f.v, l.v) AS VARCHAR) AS value, CASE WHEN f.v IS NULL THEN ends END AS expires_at FROM l LEFT JOIN f USING (user_id) WHERE f.v IS NOT NULL OR ends > TIMESTAMP '2024-01-31'""")
def stream_keyed_state(spark, sf_dir):
    """Views replace a user's value for two days, other events are kept where there is none; what is live at the end of January."""
    path = shared_path(spark, "keyed")
    events = spark.readStream.schema(read(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    ttl = F.when(F.col("event_type") == "view", F.lit(2 * 86_400)).otherwise(F.lit(0))
    writes = events.select(F.concat(F.lit("user_"), "user_id").alias("key"), F.col("event_id").cast("string").alias("value"), ttl.alias("ttl_seconds"), "ts", F.col("event_id").alias("ord"))
    for _ in range(2):  # the second run finds nothing new
        keyed.run(writes, f"{path}/changes", f"{path}/checkpoint").awaitTermination()
    return keyed.live(spark, f"{path}/changes", "2024-01-31").withColumn("expires_at", F.col("expires_at").cast("timestamp_ntz"))


def _levels(n: int) -> str:
    """SQL of ``n`` rounds of reduction by eight: rounds of texts that are done leave them as they are."""
    out = f"p0 AS (SELECT doc_id, i, {_LEAD('x')} AS t FROM (SELECT doc_id, i, substr(coalesce(text, ''), i * 4000 + 1, 4000) AS x FROM documents, range(0, 4096) r(i) WHERE i * 4000 < greatest(length(coalesce(text, '')), 1)))"
    for k in range(1, n + 1):
        out += f""",
g{k} AS (SELECT doc_id, i // 8 AS i, string_agg(t, ' ' ORDER BY i) AS x, max(last) AS last FROM (SELECT *, max(i) OVER (PARTITION BY doc_id) AS last FROM p{k - 1}) GROUP BY ALL),
p{k} AS (SELECT doc_id, i, CASE WHEN last = 0 THEN x ELSE {_LEAD('x')} END AS t FROM g{k})"""
    return out


@query(f"WITH {_levels(4)} SELECT doc_id, t AS summary FROM p4")
def summary_tree(spark, sf_dir):
    parts = summaries.parts_of(read(spark, sf_dir, "documents"), "doc_id", "text")
    return summaries.tree(parts).select(F.col("id").alias("doc_id"), "summary")


@query("SELECT CAST(date_trunc('week', ts) AS DATE) AS week, event_type, count(*) AS n, count(DISTINCT user_id) AS exact FROM events GROUP BY ALL")
def weekly_exact(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week"), "event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("exact"))


@query()
def weekly_sketches(spark, sf_dir):
    """What ``weekly_exact`` counts, and quartiles of the values, from days that are stored as sketches and merged."""
    path = shared_path(spark, "days")
    sketches.daily(read(spark, sf_dir, "events"), "ts", ["event_type"], F.col("user_id"), F.col("value")).write.parquet(path)
    weeks = sketches.merged(spark.read.parquet(path), [F.to_date(F.date_trunc("week", "day")).alias("week"), "event_type"])
    return sketches.estimates(weeks, [0.25, 0.5, 0.75])


@query()
def dedup_evaluation(spark, sf_dir):
    """Documents as posts: an update has a document's text before one of the benchmark's, of which the second should stay."""
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), "text", "doc_id")
    b = read(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("fresh"), F.lit(0).alias("all_items"))
    b = numbered(b, "all_items", "item_id", "n").select("fresh", "n")
    b = b.join(b.agg(F.count("*").alias("all")), F.lit(True))
    both = d.join(b, F.col("doc_id") % F.col("all") == F.col("n"))
    base = d.select("post_id", F.lit("base").alias("kind"), F.lit(None).cast("string").alias("dup_type"), "text")
    update = both.select("post_id", F.lit("update").alias("kind"), F.lit("exact").alias("dup_type"), F.concat_ws("\n\n", "text", "fresh").alias("text"))
    truth = both.select("post_id", F.lit("ground_truth").alias("kind"), F.lit("exact").alias("dup_type"), F.col("fresh").alias("text"))
    return evaluation.by_type(evaluation.evaluate_posts(base.unionByName(update).unionByName(truth)))

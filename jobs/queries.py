"""The jobs as queries: each runs twice into one new folder, and what stands there after the second run is the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import article_intake, weekly_collection
from sieveline.session import shared_path


def job1_article_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "job1")
    for _ in range(2):
        out = article_intake.run(spark, f"{sf_dir}/documents.parquet*", f"{path}/articles", f"{path}/checkpoint")
    return out.withColumn("topics", F.array_join(F.transform("topics", lambda t: t["name"]), ",")).withColumn("rate", F.round("rate", 6))


def job2_weekly_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "job2")
    for _ in range(2):
        out = weekly_collection.run(spark, f"{sf_dir}/events.parquet", f"{sf_dir}/documents.parquet", f"{path}/collections")
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (job1_article_intake, job2_weekly_collection)}


_WHITE = r"[\x09-\x0D\x20\x1C-\x1F\x{85}\x{A0}]+"
_REFINED = rf"regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\n+', chr(10), 'g'), '^{_WHITE}', ''), '{_WHITE}$', '')"
_LEAD = rf"""CASE WHEN length(x) <= 200 THEN x ELSE regexp_replace(regexp_replace(array_to_string(string_split(regexp_replace(x, '([.!?])[\x09-\x0D\x20]+', '\1' || chr(1), 'g'), chr(1))[1:2], ' '), '^{_WHITE}', ''), '{_WHITE}$', '') END"""

_JOB1 = rf"""
WITH t AS (SELECT doc_id, source, lang, {_REFINED} AS x FROM documents),
k AS (SELECT *, CASE WHEN doc_id IS NULL THEN 'no id' WHEN x = '' THEN 'no text' END AS reason FROM t),
f AS (SELECT x, min(doc_id) AS original FROM k WHERE reason IS NULL GROUP BY x),
s AS (
  SELECT k.*, f.original, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN k.doc_id = f.original THEN 'new' ELSE 'copy' END AS status, {_LEAD} AS lead
  FROM k LEFT JOIN (SELECT x AS y, original FROM f) f ON k.x = f.y AND k.reason IS NULL)
SELECT doc_id, source, lang, CASE WHEN reason IS NULL THEN sha256(x) END AS content_id, original, reason, CAST(length(x) AS BIGINT) AS n_chars, CAST(0 AS BIGINT) AS batch, status,
       CASE WHEN status = 'new' THEN lead END AS summary,
       CASE WHEN status = 'new' THEN CASE WHEN length(lead) > 2000 THEN '' ELSE lower(regexp_extract(lead, '^[^\x09-\x0D\x20]+')) END END AS topics,
       CASE WHEN status = 'new' THEN CASE WHEN length(lead) > 2000 THEN -0.02 ELSE round(least(1.0, (length(lead) // 2) / 1000), 6) END END AS rate
FROM s
"""

_JOB2 = rf"""
WITH e AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS week, user_id AS page_id, arg_max(least(5.0, value / 20.0), (ts, event_id)) AS rating
  FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL),
o AS (SELECT e.*, d.source, d.lang, {_REFINED} AS x FROM e JOIN documents d ON d.doc_id = e.page_id),
a AS (SELECT week + CAST(7 * k AS INTEGER) AS week, source, sum(s) / sum(c) AS relevance FROM (SELECT week, source, sum(rating) AS s, count(*) AS c FROM o GROUP BY ALL), range(1, 5) r(k) GROUP BY ALL),
b AS (SELECT o.*, round(0.8 * rating + 0.2 * coalesce(relevance, -1), 9) AS blend FROM o LEFT JOIN a USING (week, source) WHERE rating >= 2),
n AS (SELECT *, row_number() OVER (PARTITION BY week, source ORDER BY blend DESC, page_id) AS rn, string_split(x, chr(10))[1] AS title, {_LEAD} AS lead FROM b WHERE blend >= 2),
p AS (
  SELECT week, source, count(*) AS n, list(title ORDER BY rn) AS titles, list_sort(list_distinct(list(lang))) AS topics,
         '# ' || source || ', week of ' || week || chr(10) || chr(10) || string_agg('## ' || title || chr(10) || chr(10) || lead || chr(10), chr(10) ORDER BY rn) AS page
  FROM n WHERE rn <= 10 GROUP BY week, source)
SELECT * FROM p UNION ALL
SELECT w.week, NULL, rated, coalesce(list(source ORDER BY n DESC, source) FILTER (source IS NOT NULL), []),
       coalesce(list_sort(list_distinct(flatten(list(topics)))), []),
       '# Week of ' || w.week || chr(10) || chr(10) || coalesce(string_agg('* ' || source || ': ' || n || chr(10), '' ORDER BY n DESC, source) FILTER (source IS NOT NULL), '')
FROM (SELECT week, count(*) AS rated FROM e GROUP BY week) w LEFT JOIN p ON p.week = w.week GROUP BY w.week, rated
"""


def oracle_sql() -> dict[str, str]:
    return {"job1_article_intake": _JOB1, "job2_weekly_collection": _JOB2}

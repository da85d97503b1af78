"""The week's collection: the best rated pages of each week, a page of them for each source.

    spark-submit jobs/weekly_collection.py --edits in/events --articles in/articles --output out/collections \\
        [--since 2024-01-08] [--until 2024-01-15] [--config jobs/weekly_collection.json]

Reads edits of pages (event_id, ts, user_id as the page's id, event_type, value) and articles (doc_id, text, lang, source).
An edit of a rated type rates its page by value / points, 5 at most; of a week's edits of a page the last counts. Pages with
a rating of ``least_rating`` or more are blended with how their source was rated in the weeks before (``affinity_weeks`` of
them; -1 where it was not); of those with a blend of ``least_blend`` or more the best ``pages`` of each source make its
collection: a Markdown page with title and summary of each, taken from whole texts.

The output has a partition for each week (its Monday) with a row for each source and one for the whole week, whose source
is null; weeks are written whole and in place of what was there (dynamic partition overwrite), also when nothing is left of
them. So a run over the same edits gives the same weeks, and a run for some weeks leaves the others alone. ``since`` and
``until`` are Mondays; edits outside the weeks and their affinity are not read.

Edits without a page, time or value, and pages without an article, are left out. Ties go to the later event, then to the
smaller page id. The latest edit is an aggregation with map-side combine, a source's collection is cut to its best
pages in each task before the shuffle; neither gathers a busy page, source or week.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import settings
from sieveline.functions.records import blended
from sieveline.functions.text import refine
from sieveline.operators import dedup, providers, render

log = logging.getLogger("jobs.weekly_collection")

EDIT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
ARTICLE = "doc_id long, text string, lang string, source string"
STORED = "source string, n long, titles array<string>, topics array<string>, page string, week date"


@dataclass(frozen=True)
class Config:
    rated_types: list[str] = field(default_factory=lambda: ["view", "click", "purchase"])
    points: float = 20.0
    least_rating: float = 2.0
    least_blend: float = 2.0
    pages: int = 10
    affinity_weeks: int = 4


def ratings(edits: DataFrame, config: Config = Config()) -> DataFrame:
    """Rows (week, page_id, rating): a page's last rating in each week."""
    rated = edits.where(F.col("event_type").isin(*config.rated_types) & F.col("user_id").isNotNull() & F.col("ts").isNotNull() & F.col("value").isNotNull())
    week = F.to_date(F.date_trunc("week", "ts"))
    rating = F.least(F.lit(5.0), F.col("value") / config.points)
    keyed = rated.select(F.struct(week.alias("week"), F.col("user_id").alias("page_id")).alias("key"), "ts", (-F.col("event_id")).alias("ordinal"), rating.alias("rating"))
    return dedup.latest(keyed, "key", "ts", "ordinal").select("key.week", "key.page_id", "rating")


def collections(rated: DataFrame, articles: DataFrame, config: Config = Config()) -> DataFrame:
    """Rows (week, source, n, titles, topics, page) for rated pages (week, page_id, rating)."""
    owned = rated.join(articles.select(F.col("doc_id").alias("page_id"), "source", "lang", "text"), "page_id")
    by_source = owned.where("source is not null").groupBy("week", "source").agg(F.sum("rating").alias("s"), F.count("*").alias("c"))
    after = by_source.select(F.explode(F.sequence(F.lit(1), F.lit(config.affinity_weeks))).alias("k"), "*")
    before = after.groupBy(F.expr("date_add(week, 7 * k)").alias("_week"), F.col("source").alias("_source")).agg((F.sum("s") / F.sum("c")).alias("relevance"))
    kept = owned.where(F.col("rating") >= config.least_rating)
    scored = kept.join(before, (F.col("week") == F.col("_week")) & (F.col("source") == F.col("_source")), "left")
    scored = scored.withColumn("relevance", F.coalesce("relevance", F.lit(-1.0)))
    scored = scored.withColumn("blend", F.round(blended(F.col("rating"), F.col("relevance")), 9)).where(F.col("blend") >= config.least_blend)
    scored = scored.withColumn("rank", F.struct((-F.col("blend")).alias("b"), "page_id"))
    best = dedup.first_n(scored, ["week", "source"], "rank", config.pages)
    text = refine(F.coalesce("text", F.lit("")))
    title = F.element_at(F.split(text, "\n"), 1)
    entry = F.concat(F.lit("## "), title, F.lit("\n\n"), providers.lead_summary(text, limit=2**31 - 1), F.lit("\n"))
    items = best.select("week", "source", "rn", F.struct(title.alias("title"), entry.alias("entry")).alias("item"), F.array_compact(F.array("lang")).alias("topics"))
    pages = render.collection(items, ["week", "source"], "rn", "item", "topics")
    heading = F.concat(F.lit("# "), F.coalesce("source", F.lit("no source")), F.lit(", week of "), F.col("week").cast("string"), F.lit("\n\n"))
    return pages.select(
        "week", F.coalesce("source", F.lit("no source")).alias("source"), "n", F.transform("titles", lambda t: t.title).alias("titles"), "topics",
        F.concat(heading, F.array_join(F.transform("titles", lambda t: t.entry), "\n")).alias("page"),
    )


def overviews(rated: DataFrame, pages: DataFrame, weeks: DataFrame) -> DataFrame:
    """A row for each week (source null): how many pages were rated, and the sources with a collection, the largest first."""
    counts = rated.groupBy("week").agg(F.count("*").alias("rated"))
    lines = pages.groupBy("week").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "source", "topics"))).alias("s"))  # a row for each source
    rows = weeks.join(counts, "week", "left").join(lines, "week", "left").withColumn("s", F.coalesce("s", F.array().cast("array<struct<m:bigint,source:string,topics:array<string>>>")))
    listed = F.array_join(F.transform("s", lambda x: F.concat(F.lit("* "), x.source, F.lit(": "), (-x.m).cast("string"), F.lit("\n"))), "")
    return rows.select(
        "week", F.lit(None).cast("string").alias("source"), F.coalesce("rated", F.lit(0)).cast("long").alias("n"), F.transform("s", lambda x: x.source).alias("titles"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("s", lambda x: x.topics)))).alias("topics"), F.concat(F.lit("# Week of "), F.col("week").cast("string"), F.lit("\n\n"), listed).alias("page"),
    )


def read(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(output)


def run(spark: SparkSession, edits: str, articles: str, output: str, since: str | None = None, until: str | None = None, config: Config = Config()) -> DataFrame:
    """Write the collections of the weeks from ``since`` to ``until`` (all without them); the whole output as it stands then."""
    bounds = [spark.range(1).select(F.to_date(F.date_trunc("week", F.lit(d).cast("timestamp_ntz")))).first()[0] if d else None for d in (since, until)]
    if any(d and str(b) != d for d, b in zip((since, until), bounds, strict=True)):
        raise ValueError(f"since and until must be Mondays, not {since} and {until}")
    rows = spark.read.schema(EDIT).parquet(edits)
    if since:
        rows = rows.where(F.col("ts") >= F.date_sub(F.lit(since).cast("date"), 7 * config.affinity_weeks).cast("timestamp_ntz"))
    if until:
        rows = rows.where(F.col("ts") < F.date_add(F.lit(until).cast("date"), 7).cast("timestamp_ntz"))
    texts = spark.read.schema(ARTICLE).parquet(articles)
    log.info("read %d edits from %s", rows.count(), edits)
    rated = ratings(rows, config).persist()
    own = (F.lit(True) if not since else F.col("week") >= F.lit(since).cast("date")) & (F.lit(True) if not until else F.col("week") <= F.lit(until).cast("date"))
    pages = collections(rated, texts, config).where(own).persist()
    asked = spark.sql(f"SELECT explode(sequence(DATE'{bounds[0]}', DATE'{bounds[1]}', INTERVAL 7 DAYS)) AS week") if since and until else rated.where(own).select("week").distinct()
    out = pages.unionByName(overviews(rated.where(own), pages, asked))
    try:
        out.repartition("week", "source").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").parquet(output)
    finally:
        for held in (pages, rated):
            held.unpersist()
    done = read(spark, output)
    written = done.where(own).agg(F.count("*").alias("rows"), F.count_distinct("week").alias("weeks"), F.sum(F.when(F.col("source").isNotNull(), F.col("n"))).alias("pages")).first()
    log.info("wrote %d rows for %d weeks with %d pages to %s", written.rows, written.weeks, written.pages or 0, output)
    return done


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("edits", "articles", "output"):
        parser.add_argument(f"--{name}", required=True)
    for name in ("since", "until", "config"):
        parser.add_argument(f"--{name}")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("weekly-collection").getOrCreate()
    try:
        run(spark, args.edits, args.articles, args.output, args.since, args.until, settings.load(spark, args.config, Config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

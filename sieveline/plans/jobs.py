"""Scheduled jobs over a workspace: pull, save, sync, distribute, clean and recap.

A workspace is a folder with the tables that runs share: the seen-set, high-water marks, snapshots
by day, page ratings, vectors by day and published items. Each job is a function of its inputs and
the run's day; nothing reads the clock. State moves only after what it stands for was written, so a
job that fails halfway is run again as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.text import todo_items
from sieveline.operators import dedup, lists, providers, render, scoring, state
from sieveline.operators import vectors as K
from sieveline.plans import actions, pipelines
from sieveline.schemas import TABLES
from sieveline.session import materialize, remove
from sieveline.sinks import writers
from sieveline.sources import feeds, files

ITEM = "item_id string, source string, list_name string, title string, text string, url string, created_time timestamp, ordinal bigint"
SEEN = "source string, list_name string, item_id string"
MARKS = "source string, watermark timestamp"
PAGE = "item_id string, source string, title string, text string, take_aways string, tags array<string>, user_rating double, last_edited_time timestamp, ordinal bigint"
RATING = "item_id string, user_rating double, expires_at timestamp_ntz"
VECTOR = "key string, value array<float>, expires_at timestamp_ntz"
VISITED = "source string, ds date, item_id string, expires_at timestamp_ntz"
VERSION = "item_id string, last_edited_time timestamp"
NOTE = "item_id string, title string, text string, created_time timestamp"
#: Days that a rating, an embedding and the mark of a visit live (fixed value).
LIFE = 30
PUBLISHED = "item_id string, source string, list_name string, title string, url string, summary string, rate double, relevance double"


class Workspace:
    """The tables of a folder. State tables are kept in versions; readers see the last whole one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.vectors = K.Collection(spark, f"{self.path}/vectors")

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _versions(self, name: str) -> list[int]:
        fs, folder = self._fs(f"{self.path}/{name}")
        if not fs.exists(folder):
            return []
        found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("v=")]
        whole = [p for p in found if fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName()[2:]) for p in whole)

    def read(self, name: str, schema: str) -> DataFrame:
        versions = self._versions(name)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/v={versions[-1]}") if versions else self.spark.createDataFrame([], schema)

    def replace(self, name: str, df: DataFrame) -> None:
        """Write the next version, and drop all but it and the one before."""
        versions = self._versions(name)
        df.write.mode("overwrite").parquet(f"{self.path}/{name}/v={(versions or [0])[-1] + 1}")
        for v in versions[:-1]:
            remove(self.spark, f"{self.path}/{name}/v={v}")


def pull_feeds(ws: Workspace, feed_files: DataFrame, run_id: str, run_date: str, count: int = 3) -> None:
    """Entries of feed files (list_name, text; part, if feeds come in several files) as the run's items."""
    items = feeds.rss_items(feeds.feed_entries(feed_files, part="part" if "part" in feed_files.columns else None), run_date, count)
    own = items.select(F.col("id").alias("item_id"), "source", "list_name", "title", F.concat_ws("\n", "summary", "content").alias("text"), "url", "created_time", F.col("ordinal").cast("long").alias("ordinal"))
    writers.write_run(own, f"{ws.path}/news", run_id)


def scores(ws: Workspace, items: DataFrame, run_day: str, k: int = 2, max_distance: float = 0.45, embed: providers.Provider = providers.hashed_embedding, among: bool = False) -> DataFrame:
    """Rows (item_id, relevance): the mean rating of each item's nearest pages of the day's vectors, -1 without any.

    With ``among`` the items are pages of the day themselves: an item takes one of its own ``k`` places and leaves after the cut.
    """
    keyed = items.select("item_id", F.xxhash64("item_id").alias("vec_id"), embed(F.concat_ws(" - ", "title", "list_name", "text")).alias("embedding"))
    pages = ws.vectors.day(run_day).select(F.xxhash64("item_id").alias("vec_id"), "embedding", "item_id")
    rated = pages.join(state.get(ws.read("ratings", RATING), run_day), "item_id").select("vec_id", "user_rating")
    near = lists.similar_pairs(keyed, pages, max_distance, k, exclude_self=not among, metric="l2").where("query_id <> similar_id")
    return K.relevance(near, rated, "vec_id", "user_rating", keyed, "vec_id").join(keyed.select(F.col("vec_id").alias("query_id"), "item_id"), "query_id").select("item_id", "relevance")


def save(ws: Workspace, run_id: str, run_day: str, kind: str = "rss", config: pipelines.Config | None = None, limits: DataFrame | None = None) -> DataFrame:
    """Filter, rank and publish a run's items, then mark them as seen; one row of counts for each list."""
    items = files.read_run(ws.spark, f"{ws.path}/news", run_id, ITEM)
    seen = ws.read("seen", SEEN)
    fresh = dedup.unseen(items, seen, ["source", "list_name", "item_id"])
    config = config or pipelines.Config(k=1 if kind == "rss" else None)
    if kind == "article":
        out = pipelines.article(items, seen, config).withColumn("relevance", F.lit(-1.0))
    else:
        own = scores(ws, fresh, run_day)
        limits = limits if limits is not None else ws.spark.createDataFrame([], "list_name string, min_score double")
        plan = {"rss": lambda: pipelines.rss(items, seen, own, config), "twitter": lambda: pipelines.twitter(items, seen, own, limits, config), "reddit": lambda: pipelines.reddit(items, seen, own, limits, config)}
        out = plan[kind]()
    out = out if "summary" in out.columns else out.withColumn("summary", F.lit(None).cast("string"))
    path = f"{ws.path}/published/run_id={run_id}"
    out.select("item_id", "source", "list_name", "title", "url", "summary", "rate", "relevance").write.mode("overwrite").parquet(path)
    pushed = ws.spark.read.schema(PUBLISHED).parquet(path)
    counts = scoring.stage_counts({"input": items, "deduped": fresh, "pushed": pushed}, "list_name")
    rows = counts.collect()  # a row for each list, before the seen-set moves
    ws.replace("seen", dedup.mark_seen(seen, pushed, ["source", "list_name", "item_id"]))
    return ws.spark.createDataFrame(rows, counts.schema)


def sync(ws: Workspace, pages: DataFrame, run_day: str) -> None:
    """Rated pages since their source's high-water mark, the latest of each, as the day's snapshot; then the marks rise."""
    marks = ws.read("marks", MARKS)
    rated = state.since(pages.where("user_rating is not null"), marks, "source", "last_edited_time")
    path = f"{ws.path}/snapshots/ds={run_day}"
    dedup.latest(rated, "item_id", "last_edited_time", "ordinal").write.mode("overwrite").parquet(path)
    done = ws.spark.read.schema(PAGE).parquet(path)
    ws.replace("marks", state.advance(marks, done, "source", "last_edited_time"))


def _expiry(run_day: str):
    return F.lit(run_day).cast("timestamp_ntz") + F.make_dt_interval(days=F.lit(LIFE))


def distribute(ws: Workspace, run_day: str, days: int = 30, embed: providers.Provider = providers.hashed_embedding) -> DataFrame:
    """Bring ratings and the day's vectors up to the trailing days' snapshots; rows (change_type, n).

    Only texts that no run of the last LIFE days embedded are given to the provider; ratings and the
    marks of what was put where live as long.
    """
    snaps = ws.spark.read.schema(f"{PAGE}, ds date").parquet(f"{ws.path}/snapshots")
    before = state.get(ws.read("ratings", RATING), run_day)
    changed = materialize(pipelines.distribute(snaps, run_day, before, days).select("item_id", F.col("user_rating").cast("double").alias("user_rating"), "change_type"), "changed-ratings", compact=True)
    latest = dedup.latest(files.trailing_days(snaps, "ds", run_day, days), "item_id", "last_edited_time", "ordinal")
    texts = latest.select("item_id", "source", F.concat_ws(" - ", "title", "source", "text").alias("content")).withColumn("key", F.md5("content"))
    known = state.get(ws.read("embeddings", VECTOR), run_day)
    vectors = materialize(state.cache_aside(texts, known, "key", embed(F.col("content"))).select("item_id", "source", "key", "value", "cached"), "page-vectors")
    ws.vectors.drop_day(run_day)
    ws.vectors.insert(vectors.select("item_id", F.col("value").alias("embedding"), F.lit(run_day).cast("date").alias("ds")))
    fresh = vectors.where("not cached").select("key", "value").dropDuplicates(["key"])
    ws.replace("embeddings", known.unionByName(fresh.withColumn("expires_at", _expiry(run_day))))
    visits = vectors.select("source", F.lit(run_day).cast("date").alias("ds"), "item_id")
    past = state.get(ws.read("visited", VISITED), run_day).where(F.col("ds") != F.lit(run_day).cast("date"))
    ws.replace("visited", past.unionByName(visits.withColumn("expires_at", _expiry(run_day))))
    rows = changed.groupBy("change_type").agg(F.count("*").alias("n"))
    kept = dedup.unseen(before, changed, ["item_id"]).unionByName(changed.select("item_id", "user_rating").withColumn("expires_at", _expiry(run_day)))
    ws.replace("ratings", kept)
    return rows


def clean(ws: Workspace, run_day: str) -> list[str]:
    """Drop the days of vectors that are past retention."""
    return ws.vectors.drop_expired(run_day)


def recap(ws: Workspace, run_day: str, k: int = 10) -> DataFrame:
    """The week's best rated pages, blended with how similar pages were rated; empty but on Saturdays."""
    week = ws.spark.read.schema(f"{PAGE}, ds date").parquet(f"{ws.path}/snapshots")
    week = files.trailing_days(week, "ds", run_day, 7).where(F.weekday(F.lit(run_day).cast("date")) == 5)
    pages = dedup.latest(week, "item_id", "last_edited_time", "ordinal")
    items = pages.select("item_id", "title", F.col("source").alias("list_name"), F.concat_ws("\nTake aways: ", "text", "take_aways").alias("text"))
    return pipelines.weekly(pages, scores(ws, items, run_day, 4, 0.5, among=True), k)


def publish(ws: Workspace, run_day: str, k: int = 10) -> DataFrame:
    """Write the week's recap as one page for each source; rows (source, titles, topics, n)."""
    best = recap(ws, run_day, k).withColumn("topics", F.coalesce("tags", F.array().cast("array<string>")))
    path = f"{ws.path}/collections/ds={run_day}"
    render.collection(best, "source", "ordinal", "title", "topics").write.mode("overwrite").parquet(path)
    return ws.spark.read.parquet(path)


def journal(ws: Workspace, notes: DataFrame, run_day: str, agents: actions.Agents | None = None) -> DataFrame:
    """The journal page of the notes since the last one's, written under the day; then the mark rises."""
    marks = ws.read("marks", MARKS)
    own = state.since(notes.withColumn("source", F.lit("Journal")), marks, "source", "created_time", strict=True)
    path = f"{ws.path}/journal/ds={run_day}"
    actions.journal_page(own, run_day, "created_time", "title", "text", "created_time", agents).write.mode("overwrite").parquet(path)
    done = ws.spark.read.parquet(path)
    moved = done.where("last_created_time is not null").select("source", F.col("last_created_time").alias("created_time"))
    ws.replace("marks", state.advance(marks, moved, "source", "created_time"))
    return done


def todo(ws: Workspace, pages: DataFrame, run_day: str, journals: DataFrame | None = None, agents: actions.Agents | None = None) -> DataFrame:
    """To-dos of pages in versions that have none yet, one row an item (item_id, source, pos, item, translation); then the versions are marked."""
    seen = ws.read("todo_versions", VERSION)
    fresh = lambda df: dedup.unseen_versions(df, seen, "item_id", "last_edited_time")
    made = actions.todo_pages(fresh(pages), None if journals is None else fresh(journals), agents)
    path = f"{ws.path}/todo/ds={run_day}"
    made.select("item_id", "source", "last_edited_time", "todo", "translation_todo").write.mode("overwrite").parquet(path)
    done = ws.spark.read.parquet(path)
    newest = seen.unionByName(done.select("item_id", "last_edited_time")).groupBy("item_id").agg(F.max("last_edited_time").alias("last_edited_time"))
    ws.replace("todo_versions", newest)
    both = F.arrays_zip(todo_items(F.col("todo")).alias("item"), todo_items(F.col("translation_todo")).alias("translation"))
    return done.select("item_id", "source", F.posexplode(both).alias("pos", "x")).select("item_id", "source", "pos", "x.item", "x.translation").where("item is not null and translation is not null")


def deepdive(ws: Workspace, pages: DataFrame, run_day: str, iterations: int = 3, agents: actions.Agents | None = None) -> DataFrame:
    """Articles on tagged pages that never had one; then the pages are marked."""
    seen = ws.read("deepdives", "item_id string")
    path = f"{ws.path}/deepdive/ds={run_day}"
    actions.deepdive_pages(dedup.unseen(pages, seen, ["item_id"]), iterations, agents).write.mode("overwrite").parquet(path)
    done = ws.spark.read.parquet(path)
    ws.replace("deepdives", dedup.mark_seen(seen, done, ["item_id"]))
    return done


def bootstrap(ws: Workspace, rows: DataFrame) -> None:
    """Add index entries (category, name, index_id) whose category and name the workspace does not have yet; of several the smallest id."""
    held = ws.read("index_pages", TABLES["index_pages"][0])
    new = dedup.unseen(rows, held, ["category", "name"]).groupBy("category", "name").agg(F.min("index_id").alias("index_id"))
    ws.replace("index_pages", held.unionByName(new))


def upgrade(ws: Workspace, patches: list[tuple[int, str, Callable[[Workspace], None]]]) -> list[int]:
    """Run the patches (order, name, function) that the workspace has not had, in order; which these were.

    A patch is marked once it is done: one that fails halfway stays pending and stops the rest, and is run again by the
    next upgrade, so it must bear that. Two upgrades of one workspace must not run at once.
    """
    if len({o for o, _, _ in patches}) < len(patches):
        raise ValueError("patches share an order")
    listed = ws.spark.createDataFrame([(o, n) for o, n, _ in patches], TABLES["patch"][0])
    pending = [r.order_id for r in state.pending_patches(listed, ws.read("patch", TABLES["patch"][0])).collect()]  # a row for each patch
    for order, name, apply in sorted(patches, key=lambda x: x[0]):
        if order in pending:
            apply(ws)
            ws.replace("patch", ws.read("patch", TABLES["patch"][0]).unionByName(ws.spark.createDataFrame([(order, name)], TABLES["patch"][0])))
    return pending

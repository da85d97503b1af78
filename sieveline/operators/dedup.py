"""Exact, seen-before and versioned deduplication, and clusters of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.operators.components import connected_components


def unseen(items: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose keys are not in the seen-set. Null keys were never seen."""
    return items.join(seen.select(*keys), keys, "left_anti")


def unseen_versions(items: DataFrame, seen: DataFrame, id_col: str, version_col: str) -> DataFrame:
    """Items that were never seen, or not with this version."""
    return unseen(items, seen, [id_col, version_col])


def mark_seen(seen: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """The seen-set with the items' keys added, each once."""
    return seen.select(*keys).unionByName(items.select(*keys)).distinct()


def split_changes(now: DataFrame, before: DataFrame, key: str, compare: str) -> DataFrame:
    """Rows of ``now`` that are new or whose ``compare`` column changed, with ``change_type`` new or updated."""
    old = before.select(F.col(key).alias("_key"), F.col(compare).alias("_old"))
    kind = F.when(F.col("_key").isNull(), F.lit("new")).when(~F.col(compare).eqNullSafe(F.col("_old")), F.lit("updated"))
    return now.join(old, F.col(key) == F.col("_key"), "left").withColumn("change_type", kind).where("change_type is not null").drop("_key", "_old")


def first_of_content(docs: DataFrame, content: Column, order: str) -> DataFrame:
    """Rows (content_hash, original, copies): of equal contents the smallest ``order``, and how many there are.

    Aggregated on the map side, so the most copied text costs a row per task.
    """
    return docs.groupBy(F.sha2(content, 256).alias("content_hash")).agg(F.min(order).alias("original"), F.count("*").alias("copies"))


def first_rows(docs: DataFrame, content: Column, order: str) -> DataFrame:
    """The first document of each content, with all columns."""
    firsts = first_of_content(docs, content, order).select(F.col("original").alias("_first"))
    return docs.join(firsts, F.col(order) == F.col("_first"), "left_semi")


def cluster_sources(docs: DataFrame, links: DataFrame, id_col: str, source_col: str) -> DataFrame:
    """Rows (cluster_id, size, sources): connected duplicates, named by their smallest id, with all their sources."""
    roots = connected_components(links)
    own = docs.select(F.col(id_col).alias("node"), F.col(source_col).alias("source")).join(roots, "node", "left")
    return own.groupBy(F.coalesce("root", "node").alias("cluster_id")).agg(F.count("*").alias("size"), F.array_sort(F.collect_set("source")).alias("sources"))


def star_links(docs: DataFrame, content: Column, id_col: str) -> DataFrame:
    """Rows (u, v) that link each copy to the first of its content: one row a copy, not one a pair."""
    keyed = docs.select(F.col(id_col).alias("v"), F.sha2(content, 256).alias("h"))
    first = keyed.groupBy("h").agg(F.min("v").alias("u"))
    return keyed.join(first, "h").where("u <> v").select("u", "v")


def latest(items: DataFrame, key: str, version: str, ordinal: str) -> DataFrame:
    """The row of greatest version of each key; of equal versions the one that came first.

    An aggregation with map-side combine instead of a window, so that a key with very many
    versions never gathers in one task.
    """
    others = [c for c in items.columns if c not in (key, version, ordinal)]
    best = F.max_by(F.struct(*others, version, ordinal) if others else F.struct(version, ordinal), F.struct(F.col(version), -F.col(ordinal)))
    out = items.groupBy(key).agg(best.alias("_best"))
    return out.select(*(F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in items.columns))


def last_loaded(items: DataFrame, key: str, load: str) -> DataFrame:
    """The row that was loaded last of each key, whatever its version."""
    others = [c for c in items.columns if c != key]
    out = items.groupBy(key).agg(F.max_by(F.struct(*others), F.col(load)).alias("_last"))
    return out.select(*(F.col(c) if c == key else F.col(f"_last.{c}").alias(c) for c in items.columns))


def first_n(items: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark limits each task to ``n`` a group before the shuffle."""
    return items.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(order))).where(F.col("rn") <= n)

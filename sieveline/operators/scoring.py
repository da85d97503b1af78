"""Filters, rankings and buckets over scored items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.records import blended, falsy

#: Upper bounds of rating buckets (fixed values); above the last is not counted.
BUCKETS = (0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def keeps(score: Column, least: Column | float) -> Column:
    """Unknown (negative) scores pass, others if they reach the bound."""
    return (score < 0) | (score >= least)


def top_k(items: DataFrame, score: str, ordinal: str, k: int) -> DataFrame:
    """The ``k`` highest scores, ties in their order: a bounded heap in each task, no full sort."""
    return items.orderBy(F.col(score).desc(), F.col(ordinal)).limit(k)


def filter_top(items: DataFrame, score: str, ordinal: str, k: int = 3, least: float = 4.0) -> DataFrame:
    return top_k(items.where(keeps(F.col(score), least)), score, ordinal, k)


def filter_by_list(items: DataFrame, limits: DataFrame, list_col: str, score: str, default: float) -> DataFrame:
    """Scores against their list's bound; a bound of 0 or none is the default.

    Bounds are a configuration of some hundred rows; Spark broadcasts them by their size.
    """
    own = limits.select(F.col("list_name").alias("_list"), F.col("min_score").alias("_least"))
    joined = items.join(own, F.col(list_col) == F.col("_list"), "left")
    return joined.where(keeps(F.col(score), falsy(F.col("_least"), default))).drop("_list", "_least")


def weekly_filter(items: DataFrame, rating: str, relevance: str, ordinal: str, k: int = 10, least: float = 4.5) -> DataFrame:
    """Filtered by the blend of rating and relevance, ordered by relevance alone."""
    scored = items.withColumn("blended", blended(F.col(rating), F.col(relevance))).where(F.col("blended") >= least)
    return top_k(scored, relevance, ordinal, k)


def rank_skip(score: Column, text: Column, enabled: bool, least: float, limit: int = 2000) -> Column:
    """Whether an item is not worth ranking: ranking is off, its known non-zero score is low, or its text is long."""
    return F.lit(not enabled) | ((score > 0) & (score < least)) | (F.length(text) > limit)


def rating_bucket(rating: Column) -> Column:
    out = F.lit(None).cast("string")
    for bound in reversed(BUCKETS):
        out = F.when(rating <= bound, F.lit(f"<={bound}")).otherwise(out)
    return out


def histogram(items: DataFrame, group: str, rating: Column) -> DataFrame:
    """Rows (group, bucket, n)."""
    return items.withColumn("bucket", rating_bucket(rating)).where("bucket is not null").groupBy(group, "bucket").agg(F.count("*").alias("n"))


def stage_counts(stages: dict[str, DataFrame], group: str) -> DataFrame:
    """One row per group with a count for each named stage."""
    parts = [df.groupBy(F.col(group).alias("source")).agg(F.count("*").alias("n")).withColumn("stage", F.lit(name)) for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    counted = out.groupBy("source").pivot("stage", list(stages)).agg(F.sum("n"))
    return counted.select("source", *(F.coalesce(s, F.lit(0)).cast("long").alias(s) for s in stages))


def confusion(rows: DataFrame, predicted: Column, actual: Column, by: list[str] | None = None) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1, accuracy (0 where undefined), for each group of ``by``."""
    n = lambda c: F.count_if(c).cast("double")
    counts = rows.groupBy(*(by or [])).agg(
        n(predicted & actual).alias("tp"), n(predicted & ~actual).alias("fp"), n(~predicted & actual).alias("fn"), n(~predicted & ~actual).alias("tn")
    )
    over = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (
        counts.withColumn("precision", over(tp, tp + fp)).withColumn("recall", over(tp, tp + fn))
        .withColumn("f1", over(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
        .withColumn("accuracy", over(tp + tn, tp + fp + fn + tn))
    )

"""Evaluation of deduplication against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.operators.scoring import confusion

#: Containment from which a text counts as found in the truth.
OVERLAP = 0.3


def evaluate_kept(kept: DataFrame, is_kept: str, overlap: str, threshold: float = OVERLAP, by: list[str] | None = None) -> DataFrame:
    """Confusion of keeping against the truth: a text belongs to the truth if its overlap reaches the threshold."""
    return confusion(kept, F.col(is_kept), F.col(overlap) >= threshold, by)


def sweep(rows: DataFrame, score: str, actual: str, thresholds: list[float]) -> DataFrame:
    """A confusion row for each threshold, in one pass over the rows."""
    each = rows.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    return confusion(each, F.col(score) >= F.col("threshold"), F.col(actual), ["threshold"])


def macro(rows: DataFrame) -> DataFrame:
    """Unweighted means of the rates over rows."""
    return rows.agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1", "accuracy")))


def dedup_rates(docs: DataFrame, by: str, content: Column) -> DataFrame:
    """Rows (by, n, duplicates, dedup_rate): how many of a group's documents repeat another one's content."""
    each = docs.select(by, F.sha2(content, 256).alias("_h")).groupBy(by).agg(F.count("*").alias("n"), F.count_distinct("_h").alias("_d"))
    return each.select(by, "n", (F.col("n") - F.col("_d")).alias("duplicates"), (1 - F.col("_d") / F.col("n")).alias("dedup_rate"))

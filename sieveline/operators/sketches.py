"""Mergeable day-by-day summaries: how many different items, and how scores are distributed, without the items.

A day of a group is one row with counts, a HyperLogLog sketch of its contents and a KLL sketch of its scores. Days merge to weeks, to
all sources, or with days that were stored before, without reading items again; a day's row has a bounded size whatever the day holds.
With ``LG_K`` = 12 the estimate of different items is off by about 1.6 % (one standard error); with ``K`` = 200 a quantile is
that of a rank at most some 1.7 % away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, K = 12, 200


def daily(items: DataFrame, ts: str, by: list[str], content: Column, score: Column) -> DataFrame:
    """Rows (day, *by, n, n_scored, uniques, scores); null contents and scores are not counted in the sketches."""
    rows = items.select(F.to_date(ts).alias("day"), *by, content.alias("_c"), score.cast("double").alias("_s"))
    return rows.groupBy("day", *by).agg(
        F.count("*").alias("n"), F.count("_s").alias("n_scored"), F.hll_sketch_agg("_c", F.lit(LG_K)).alias("uniques"), F.kll_sketch_agg_double("_s", F.lit(K)).alias("scores")
    )


def merged(days: DataFrame, by: list[Column | str]) -> DataFrame:
    """Rows (*by, n, n_scored, uniques, scores) of days put together."""
    return days.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("n_scored").alias("n_scored"), F.hll_union_agg("uniques").alias("uniques"), F.kll_merge_agg_double("scores", F.lit(K)).alias("scores")
    )


def estimates(rows: DataFrame, ranks: list[float]) -> DataFrame:
    """Sketches as numbers: ``unique`` and an array ``quantiles`` of the scores at the ranks, null for no scores."""
    kept = [c for c in rows.columns if c not in ("uniques", "scores", "n_scored")]
    values = F.kll_sketch_get_quantile_double("scores", F.array(*map(F.lit, ranks)))
    return rows.select(*kept, F.hll_sketch_estimate("uniques").alias("unique"), F.when(F.col("n_scored") > 0, values).alias("quantiles"))

"""Health of sources and pace of reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.session import materialize


def source_health(pulls: DataFrame, source: str, ts: str, ordinal: str, failed: Column, streak: int = 3) -> DataFrame:
    """Rows (source, pulls, failure_rate, last_success, failing): failing if ``streak`` or more pulls failed in a row.

    Pulls are dealt by ranges of (source, time), so a source of any size is spread over tasks. Each task sums its part of a
    source up to the failures it begins and ends with, its longest run of them and its counts; parts are put together in
    their order, a run that ends one part going on in the next. What is gathered is a row a task and source.
    """
    order = [F.col(c).asc_nulls_first() for c in (source, ts, ordinal)]
    rows = pulls.select(source, ts, ordinal, F.coalesce(failed, F.lit(False)).alias("_failed")).repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    rows = materialize(rows, "dealt-pulls")  # the parts must be the same wherever they are read
    own = ["_part", source]
    before = Window.partitionBy(*own).orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, 0)
    islands = rows.withColumn("_island", F.count_if(~F.col("_failed")).over(before))
    runs = islands.groupBy(*own, "_island").agg(F.count("*").alias("_n"), F.count_if("_failed").alias("_run"), F.max(F.when(~F.col("_failed"), F.col(ts))).alias("_last"))
    parts = runs.groupBy(*own).agg(
        F.sum("_n").alias("n"), F.sum("_run").alias("fails"), F.max("_last").alias("last"), F.max("_run").alias("longest"), F.max("_island").alias("good"),
        F.sum(F.when(F.col("_island") == 0, F.col("_run")).otherwise(0)).alias("head"), F.max_by("_run", "_island").alias("tail"),
    )
    summary = F.struct("_part", "good", "n", "head", "tail", "longest")
    each = parts.groupBy(source).agg(F.sum("n").alias("pulls"), F.sum("fails").alias("_fails"), F.max("last").alias("last_success"), F.array_sort(F.collect_list(summary)).alias("_parts"))
    start = F.struct(F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("best"))

    def follow(s: Column, p: Column) -> Column:
        whole = s.run + p.n  # a part that only failed
        run = F.when(p.good == 0, whole).otherwise(p.tail)
        best = F.when(p.good == 0, F.greatest(s.best, whole)).otherwise(F.greatest(s.best, s.run + p.head, p.longest))
        return F.struct(run.alias("run"), best.alias("best"))

    return each.select(
        source, "pulls", F.round(F.col("_fails") / F.col("pulls"), 6).alias("failure_rate"), "last_success", (F.aggregate("_parts", start, follow).best >= streak).alias("failing")
    )


def review_velocity(events: DataFrame, item: str, ts: str, started: Column, done: Column, run_day: str, limit: int = 7) -> DataFrame:
    """Rows (item, days, stuck): days from the first start to the first end or the run, and whether it waits for more than ``limit`` days."""
    each = events.groupBy(item).agg(F.min(F.when(started, F.col(ts))).alias("_from"), F.min(F.when(done, F.col(ts))).alias("_to")).where("_from is not null")
    run = F.lit(run_day).cast("date")
    days = F.datediff(F.coalesce(F.to_date("_to"), run), F.to_date("_from")).cast("long")
    return each.select(item, days.alias("days"), (F.col("_to").isNull() & (F.datediff(run, F.to_date("_from")) > limit)).alias("stuck"))


def funnel(items: DataFrame, dimensions: list[str], status: str) -> DataFrame:
    """Rows (*dimensions, n, approved, approval_rate) for each combination and its totals; the rate is that of decided items."""
    good = F.count_if(F.col(status) == "approved")
    decided = F.count_if(F.col(status).isin("approved", "rejected"))
    rate = F.coalesce(F.try_divide(good, decided), F.lit(0.0))
    return items.rollup(*dimensions).agg(F.count("*").alias("n"), good.alias("approved"), rate.alias("approval_rate"))


def weekly_funnel(items: DataFrame, ts: str, content: Column, score: Column, top: float = 5.0) -> DataFrame:
    """Rows (week, ingested, unique, top_scored) by the Monday that weeks begin with."""
    rows = items.select(F.to_date(F.date_trunc("week", ts)).alias("week"), F.sha2(content, 256).alias("_h"), (score >= top).alias("_top"))
    return rows.groupBy("week").agg(F.count("*").alias("ingested"), F.count_distinct("_h").alias("unique"), F.count_if("_top").alias("top_scored"))


def weak_sources(items: DataFrame, source: str, ts: str, status: str, run_day: str, least: float = 0.2, silent: int = 14) -> DataFrame:
    """Rows (source, approval_rate, last_item, low_approval, silent): sources with little approval, or nothing for ``silent`` days."""
    good, decided = F.count_if(F.col(status) == "approved"), F.count_if(F.col(status).isin("approved", "rejected"))
    each = items.groupBy(source).agg(F.try_divide(good, decided).alias("approval_rate"), F.max(ts).alias("last_item"))
    days = F.datediff(F.lit(run_day).cast("date"), F.to_date("last_item"))
    return each.select(source, "approval_rate", "last_item", F.coalesce(F.col("approval_rate") < least, F.lit(False)).alias("low_approval"), (days >= silent).alias("silent"))

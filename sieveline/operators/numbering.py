"""Row numbers within groups that need not fit one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.session import materialize


def numbered(rows: DataFrame, group: str, order: str, name: str = "place") -> DataFrame:
    """Rows with their place (from 0) in their group's order; a group may be any share of the table.

    Rows are dealt by ranges of (group, order), so a large group is spread over tasks; each task
    numbers its part, and the sizes of the parts before it (a row per task and group) are added.
    The dealt table is written once, as both passes must see the same ranges.
    """
    dealt = rows.repartitionByRange(F.col(group).asc_nulls_first(), F.col(order).asc_nulls_first()).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "numbered")
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(F.col("_part").alias("_p"), F.col(group).alias("_g")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_p", "_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part", group).orderBy(F.col(order).asc_nulls_first())) - 1
    local = dealt.withColumn("_own", own)
    joined = local.join(starts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*rows.columns, (F.col("_own") + F.col("_start")).cast("long").alias(name))

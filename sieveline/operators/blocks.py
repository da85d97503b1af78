"""Text of pages that are trees of content blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.text import NESTING_BLOCKS, block_text, table_row
from sieveline.session import materialize


def page_text(blocks: DataFrame, separator: str = "") -> DataFrame:
    """Rows (page_id, text, n): the blocks (page_id, block_id, parent_id, pos, type, text) of each page, depth first.

    A block without parent is a top block; each top block's text, with what hangs below it, ends with
    the separator, the last one's too. Children count below toggles and tables, whatever their depth:
    each level is one join of the children with the places of their parents, until a level is empty.
    Blocks below other kinds or without a known parent are left out. A column ``cells`` (array of
    strings), where there is one, is the text of table rows.
    """
    text = F.coalesce("text", F.lit(""))
    if "cells" in blocks.columns:
        text = F.when((F.col("type") == "table_row") & F.col("cells").isNotNull(), table_row(F.col("cells"))).otherwise(text)
    rows = blocks.select("page_id", "block_id", "parent_id", F.col("pos").cast("long").alias("pos"), "type", block_text(F.col("type"), text).alias("own"))
    level = rows.where("parent_id is null").select("page_id", "block_id", "type", "own", F.array("pos").alias("place"))
    found = level
    while True:
        parents = level.where(F.col("type").isin(*NESTING_BLOCKS)).select("page_id", F.col("block_id").alias("parent_id"), F.col("place").alias("_above"))
        below = rows.join(parents, ["page_id", "parent_id"]).select("page_id", "block_id", "type", "own", F.concat("_above", F.array("pos")).alias("place"))
        level = materialize(below, "blocks", compact=True)
        if level.isEmpty():
            break
        found = found.unionByName(level)
    top = found.groupBy("page_id", F.element_at("place", 1).alias("top")).agg(F.array_sort(F.collect_list(F.struct("place", "own"))).alias("all"), F.count("*").alias("n"))
    joined = top.select("page_id", "top", F.concat(F.array_join(F.transform("all", lambda x: x["own"]), ""), F.lit(separator)).alias("own"), "n")
    each = joined.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("top", "own"))).alias("all"), F.sum("n").alias("n"))
    return each.select("page_id", F.array_join(F.transform("all", lambda x: x["own"]), "").alias("text"), "n")

"""Summaries of long texts by map and reduce: parts are summarised, then groups of summaries, until one is left.

A text becomes rows of parts; a provider sees one part at a time, of ``size`` characters or the summaries of ``fan`` parts.
Each round groups a text's summaries by their place, ``fan`` at a time, so a group is bounded however long the text is, and
texts of one part are done and take no part in further rounds. There are log_fan(parts of the longest text) rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators import providers
from sieveline.session import materialize

SIZE, FAN = 4000, 8


def parts_of(docs: DataFrame, doc_id: str, text: str, size: int = SIZE) -> DataFrame:
    """Rows (row, id, place, text): texts cut every ``size`` characters; a null or empty text is one empty part."""
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    last = F.greatest(F.ceil(F.length("t") / size), F.lit(1)) - 1
    each = own.select("row", "id", "t", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("place"))
    return each.select("row", "id", "place", F.substring("t", (F.col("place") * size + 1).cast("int"), F.lit(size)).alias("text"))


def tree(parts: DataFrame, summarize: providers.Provider = providers.lead_summary, reduce: providers.Provider | None = None, fan: int = FAN) -> DataFrame:
    """Rows (row, id, summary) for rows (row, id, place, text) with places from 0.

    ``reduce`` (``summarize`` unless given) sees the summaries of a group, joined by blanks.
    """
    if fan < 2:
        raise ValueError(f"groups of {fan} never become one")
    now = materialize(parts.select("row", "id", "place", F.coalesce(summarize(F.col("text")), F.lit("")).alias("text")), "summaries")
    done = []
    while True:
        sizes = now.groupBy("row").agg(F.max("place").alias("last")).withColumnRenamed("row", "_row")
        marked = now.join(sizes, F.col("row") == F.col("_row"))
        done.append(marked.where("last = 0").select("row", "id", F.col("text").alias("summary")))
        rest = marked.where("last > 0")
        groups = rest.groupBy("row", F.expr(f"place div {fan}").alias("group")).agg(F.first("id").alias("id"), F.array_sort(F.collect_list(F.struct("place", "text"))).alias("s"))  # fan at most
        joined = F.array_join(F.transform("s", lambda x: x.text), " ")
        now = materialize(groups.select("row", "id", F.col("group").alias("place"), F.coalesce((reduce or summarize)(joined), F.lit("")).alias("text")), "summaries", compact=True)
        if now.isEmpty():
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out

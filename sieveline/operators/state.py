"""High-water marks and keyed state with expiry, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.session import materialize


#: Days that values of a kind live, and how their keys are made (fixed values); kinds without days live on.
LIVES = {"ranking": 14, "summary": 14, "embedding": 28, "vector": 28, "collection_item": 28, "page": 30}
KEYS = {
    "inbox_created": ("source", "list_name"), "inbox_item": ("source", "list_name", "item_id"), "toread_item": ("source", "list_name", "item_id"),
    "toread_edited": ("source", "list_name"), "ranking": ("source", "list_name", "item_id"), "summary": ("source", "list_name", "item_id"),
    "obsidian_item": ("source", "list_name", "item_id"), "embedding": ("source", "provider", "item_id"), "vector": ("provider", "model", "source", "item_id"),
    "collection_item": ("source", "ds", "item_id"), "page": ("item_id",), "todo": ("item_id",), "action": ("item_id",),
}


def key_of(kind: str) -> Column:
    """The key of a kind of state, from the columns that make it: ``kind_part_part``."""
    return F.concat_ws("_", F.lit(kind), *(F.col(c).cast("string") for c in KEYS[kind]))


def writes(items: DataFrame, kind: str, value: Column, order: Column) -> DataFrame:
    """Writes (key, value, ttl_seconds, ord) of a kind of state for ``put``, with the kind's life."""
    return items.select(key_of(kind).alias("key"), value.cast("string").alias("value"), F.lit(86_400 * LIVES.get(kind, 0)).alias("ttl_seconds"), order.cast("long").alias("ord"))


def since(items: DataFrame, watermarks: DataFrame, key: str | list[str], ts: str, strict: bool = False, start: str | None = None) -> DataFrame:
    """Items at or (``strict``) after their key's high-water mark; keys without a mark keep all, or all from ``start`` on."""
    keys = [key] if isinstance(key, str) else key
    marks = watermarks.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), F.col("watermark").alias("_mark"))
    late = F.col(ts) > F.col("_mark") if strict else F.col(ts) >= F.col("_mark")
    own = F.lit(True)
    for i, k in enumerate(keys):
        own = own & (F.col(k) == F.col(f"_key{i}"))
    fresh = F.col("_mark").isNull() if start is None else F.col("_mark").isNull() & (F.col(ts) >= F.lit(start).cast(items.schema[ts].dataType))
    return items.join(marks, own, "left").where(fresh | late).drop(*(f"_key{i}" for i in range(len(keys))), "_mark")


def advance(watermarks: DataFrame, items: DataFrame, key: str | list[str], ts: str) -> DataFrame:
    """Rows (key, watermark): marks that only ever rise."""
    keys = [key] if isinstance(key, str) else key
    both = watermarks.select(*keys, "watermark").unionByName(items.select(*keys, F.col(ts).alias("watermark")))
    return both.groupBy(*keys).agg(F.max("watermark").alias("watermark"))


def put(state: DataFrame, writes: DataFrame, run_ts: str, key: str = "key", overwrite: bool = False) -> DataFrame:
    """The state (key, value, expires_at) after a batch of writes (key, value, ttl_seconds, ord).

    A write with a time to live, or any with ``overwrite``, replaces; one without is inserted only
    where its key has no live value. Writes apply in their order; expired rows are gone at ``run_ts``.
    """
    live = state.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(run_ts).cast("timestamp_ntz")))
    replaces = F.lit(True) if overwrite else F.col("ttl_seconds") > 0
    expires = F.when(F.col("ttl_seconds") > 0, F.lit(run_ts).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("ttl_seconds").cast("decimal(18,6)")))
    new = writes.select(key, "value", expires.alias("expires_at"), replaces.alias("_wins"), F.col("ord").alias("_ord"))
    old = live.select(key, "value", "expires_at", F.lit(True).alias("_wins"), F.lit(-1).cast("long").alias("_ord"))
    # the last that replaces, and else the first that was inserted
    rank = F.struct(F.when(F.col("_wins"), F.col("_ord")).otherwise(F.lit(-2)), F.when(~F.col("_wins"), -F.col("_ord")).otherwise(F.lit(0)))
    best = old.unionByName(new).groupBy(key).agg(F.max_by(F.struct("value", "expires_at"), rank).alias("_best"))
    return best.select(key, "_best.value", "_best.expires_at")


def get(state: DataFrame, run_ts: str) -> DataFrame:
    """The rows that are live at ``run_ts``."""
    return state.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(run_ts).cast("timestamp_ntz")))


def cache_aside(items: DataFrame, cache: DataFrame, key: str, compute: Column) -> DataFrame:
    """Items with ``value`` and ``cached``: the cached value, or ``compute`` (a column) for the misses alone, once a distinct key.

    Hits and misses part before the computation: a Python provider inside a condition would run for all rows. Of the misses
    that share a key one row is computed and all get its value, so items of a key must agree in what ``compute`` reads; misses
    without a key are each computed by themselves. What is computed is written once, and a key that very many items share is
    one row there.
    """
    known = cache.select(F.col(key).alias("_key"), F.col("value").alias("_value"))
    same = F.col(key) == F.col("_key")
    hits = items.join(known, same).withColumn("value", F.col("_value")).withColumn("cached", F.lit(True)).drop("_key", "_value")
    misses = items.join(known, same, "left_anti")
    keyed, rest = misses.where(F.col(key).isNotNull()), misses.where(F.col(key).isNull())
    made = materialize(keyed.dropDuplicates([key]).select(F.col(key).alias("_key"), compute.alias("_value")), "computed-values")
    found = keyed.join(made, same).withColumn("value", F.col("_value")).drop("_key", "_value")
    return hits.unionByName(found.unionByName(rest.withColumn("value", compute)).withColumn("cached", F.lit(False)))


def pending_patches(patches: DataFrame, applied: DataFrame, order_col: str = "order_id") -> DataFrame:
    """Patches whose order is not among the applied ones, in order."""
    return patches.join(applied.select(order_col), order_col, "left_anti").orderBy(order_col)

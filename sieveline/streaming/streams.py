"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sieveline.operators import lists


def unseen(stream: DataFrame, keys: list[str], ts: str | None = None, horizon: str = "30 days") -> DataFrame:
    """Each key once; with an event time, state is dropped behind the horizon."""
    if ts is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, ts: str, by: list[str], length: str = "1 day", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Rows (window_start, *by, n, total) of event-time windows; late rows count until the watermark passes."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    out = stream.withWatermark(ts, late).groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *by, "n", "total")


def latest(stream: DataFrame, key: str, version: str) -> DataFrame:
    """Each key's row of newest version, whenever it changes (update mode); of equal versions the first stays.

    The state of a key is one value, its newest version. Rows without a version are left out.
    """
    kind = stream.schema[version].dataType.simpleString()

    def newest(_key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, known = None, state.get[0] if state.exists else None
        for part in parts:
            part = part[part[version].notna()]
            if part.empty:
                continue
            top = part.loc[[part[version].idxmax()]]
            if best is None or top[version].iloc[0] > best[version].iloc[0]:
                best = top
        if best is not None and (known is None or best[version].iloc[0] > known):
            state.update((best[version].iloc[0].item() if hasattr(best[version].iloc[0], "item") else best[version].iloc[0],))
            yield best

    return stream.groupBy(key).applyInPandasWithState(newest, stream.schema, f"version {kind}", "update", GroupStateTimeout.NoTimeout)


def each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``apply`` on everything that arrived since the checkpoint, then stop: the scheduled form of a stream."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unique_vectors(stream: DataFrame, store: str, threshold: float, checkpoint: str, k: int = 5) -> StreamingQuery:
    """Append the vectors of a stream (vec_id, embedding) that resemble none of the store, and the mappings of the others, then stop.

    The store is a folder with ``vectors`` and ``mappings``, each partitioned by epoch. An epoch that is run again after a crash
    is compared with the epochs before it and replaces its own partitions, so nothing is appended twice; what a store begins
    with lies in an epoch below 0.
    """
    schema = f"vec_id long, embedding array<float>, {EPOCH} long"

    def take(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        held = spark.read.schema(schema).parquet(f"{store}/vectors").where(F.col(EPOCH) < epoch) if epoch or _exists(spark, f"{store}/vectors") else spark.createDataFrame([], schema)
        unique, _, mappings = lists.split_new(batch.select("vec_id", "embedding"), held, threshold, k)
        unique.write.mode("overwrite").parquet(f"{store}/vectors/{EPOCH}={epoch}")
        mappings.select("vec_id", "similar_id", "score", "rn").write.mode("overwrite").parquet(f"{store}/mappings/{EPOCH}={epoch}")

    return each_batch(stream, take, checkpoint)


EPOCH = "epoch"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True

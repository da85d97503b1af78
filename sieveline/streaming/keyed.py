"""Keyed state with expiry as a stream: insert-if-absent, replace, and a time to live that frees the state.

Writes are rows (key, value, ttl_seconds, ts, ord). One with a time to live, or any with ``overwrite``, replaces what its key has;
one without is inserted only where the key has no value that is live at the write's time. Time is event time: a key's writes
apply by (ts, ord) within a batch, and a timer at a value's expiry drops it from the state once the watermark is there.

What comes out is a log of changes (key, value, expires_at, ts, change): ``put`` when a value came to be, ``expired`` when one
was dropped. ``live`` reads the state at a time from it. The state of a key is one value, whatever the number of its writes; a
batch holds no more of a key's writes than its files do, which ``maxFilesPerTrigger`` bounds.

Writes without a key or time are left out; those behind the watermark are late and dropped by Spark. A null value is a value.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

CHANGE = "key string, value string, expires_at timestamp, ts timestamp, change string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Expiring(StatefulProcessor):
    """One value a key: (value, expires, written) in microseconds, 0 for a value that never expires."""

    def __init__(self, overwrite: bool):
        self.overwrite = overwrite

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "value string, expires long, written long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803 (Spark's names)
        before = now = self.held.get() if self.held.exists() else None
        for at, _, ttl, value in sorted(((r.micros, r.ord, r.ttl_seconds or 0, r.value) for r in rows), key=lambda w: w[:2]):
            if ttl > 0 or self.overwrite or now is None or 0 < now[1] <= at:
                now = (value, at + ttl * 1_000_000 if ttl > 0 else 0, at)
        if now is not before:
            self.held.update(now)
            if now[1]:
                self.handle.registerTimer(-(-now[1] // 1000))
            yield self._change(key[0], now, now[2], "put")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = self.held.get() if self.held.exists() else None
        if now is not None and now[1] and -(-now[1] // 1000) <= expiredTimerInfo.getExpiryTimeInMs():  # not one that was replaced since
            self.held.clear()
            yield self._change(key[0], now, now[1], "expired")

    def close(self) -> None:
        pass

    @staticmethod
    def _change(key: str, held: tuple, at: int, change: str) -> Row:
        return Row(key=key, value=held[0], expires=held[1], at=at, change=change)


def changes(writes: DataFrame, late: str = "1 day", overwrite: bool = False) -> DataFrame:
    """The changes that a stream of writes makes, as CHANGE; needs the RocksDB state store (``run`` sets it)."""
    own = writes.where("key is not null and ts is not null").select("key", "value", "ttl_seconds", F.col("ts").cast("timestamp").alias("ts"), "ord")
    own = own.withWatermark("ts", late).withColumn("micros", F.unix_micros("ts"))
    out = own.groupBy("key").transformWithState(_Expiring(overwrite), "key string, value string, expires long, at long, change string", "Append", "EventTime")
    expires = F.when(F.col("expires") > 0, F.timestamp_micros("expires"))
    return out.select("key", "value", expires.alias("expires_at"), F.timestamp_micros("at").alias("ts"), "change")


def run(writes: DataFrame, path: str, checkpoint: str, late: str = "1 day", overwrite: bool = False) -> StreamingQuery:
    """Append the changes of what arrived since the checkpoint to the files of ``path``, then stop."""
    conf = writes.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        stream = changes(writes, late, overwrite).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        return stream.trigger(availableNow=True).start()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)


def live(spark: SparkSession, path: str, at: str) -> DataFrame:
    """Rows (key, value, expires_at): what is live at a time after all writes, by the last change of each key."""
    log = spark.read.schema(CHANGE).parquet(path)
    # of an expiry and a write at the same moment the write is the later change
    last = log.groupBy("key").agg(F.max_by(F.struct("value", "expires_at", "change"), F.struct("ts", F.col("change") == "put")).alias("x"))
    own = last.select("key", "x.value", "x.expires_at", "x.change").where("change = 'put'").drop("change")
    return own.where(F.col("expires_at").isNull() | (F.col("expires_at") > F.lit(at).cast("timestamp")))

import random
from datetime import datetime, timedelta

import pytest

from sieveline.streaming import keyed

SCHEMA = "key string, value string, ttl_seconds long, ts timestamp_ntz, ord long"
START = datetime(2024, 1, 1)


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def brute(batches, at, overwrite=False):
    """Writes applied one by one, each batch by time."""
    held = {}
    for batch in batches:
        for key, value, ttl, ts, _ in sorted((w for w in batch if w[0] is not None and w[3] is not None), key=lambda w: w[3:]):
            old = held.get(key)
            if ttl or overwrite or old is None or (old[1] and old[1] <= ts):
                held[key] = (value, ts + timedelta(seconds=ttl) if ttl else None)
    return sorted((k, v, e) for k, (v, e) in held.items() if e is None or e > at)


def batch(rng, day, n=60):
    return [(f"k{rng.randrange(9)}", f"v{rng.randrange(10**6)}", rng.choice([0, 0, 3600, 6 * 3600, 90_000]), START + timedelta(days=day, seconds=rng.randrange(86_400)), i) for i in range(n)]


@pytest.mark.parametrize("overwrite", [False, True])
def test_writes_apply_as_one_by_one_and_after_a_restart(spark, tmp_path, overwrite):
    rng = random.Random(5)
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    batches = []
    for day in range(3):
        batches.append(batch(rng, day) + [(None, "x", 0, START, 0), ("nowhen", "x", 0, None, 0), (f"null{day}", None, 0, START + timedelta(days=day), 1)])
        arrive(spark, source, batches[-1])
        for _ in range(2):  # the second finds nothing new
            keyed.run(spark.readStream.schema(SCHEMA).parquet(source), out, log, overwrite=overwrite).awaitTermination()
        at = START + timedelta(days=day + 1)
        got = sorted((r.key, r.value, r.expires_at) for r in keyed.live(spark, out, str(at)).collect())
        assert got == brute(batches, at, overwrite)
    assert spark.conf.get(keyed._PROVIDER) != keyed._ROCKS


def test_expired_values_leave_the_state(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    run = lambda: keyed.run(spark.readStream.schema(SCHEMA).parquet(source), out, log, late="1 hour").awaitTermination()
    at = lambda hours: START + timedelta(hours=hours)
    arrive(spark, source, [("a", "1", 3600, at(0), 0), ("b", "1", 0, at(0), 0), ("c", "1", 3600, at(0), 0), ("c", "2", 36_000, at(0.5), 0)])
    run()
    arrive(spark, source, [("other", "1", 0, at(5), 0)])  # the watermark is four hours on
    run()
    log_of = lambda: sorted((r.key, r.value, r.change) for r in spark.read.parquet(out).collect())
    assert log_of() == [("a", "1", "expired"), ("a", "1", "put"), ("b", "1", "put"), ("c", "2", "put"), ("other", "1", "put")]
    arrive(spark, source, [("a", "again", 0, at(6), 0), ("b", "ignored", 0, at(6), 0), ("a", "too late", 0, at(1), 0)])
    run()
    assert [(r.key, r.value) for r in keyed.live(spark, out, str(at(7))).orderBy("key").collect()] == [("a", "again"), ("b", "1"), ("c", "2"), ("other", "1")]
    assert keyed.live(spark, out, str(at(20))).count() == 3

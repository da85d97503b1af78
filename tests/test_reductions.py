import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sieveline.operators import health, sketches, state, summaries


def brute_health(rows, streak=3):
    out = {}
    for source in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == source), key=lambda r: (r[0] or datetime.min, r[1]))
        run = best = 0
        for *_, failed in own:
            run = run + 1 if failed else 0
            best = max(best, run)
        good = [ts for ts, _, failed in own if not failed and ts]
        out[source] = (len(own), round(sum(bool(f) for *_, f in own) / len(own), 6), max(good, default=None), best >= streak)
    return out


@pytest.mark.parametrize("share", [0.2, 0.6, 0.97])
def test_runs_of_failures_across_parts(spark, share):
    rng = random.Random(share)
    start = datetime(2024, 1, 1)
    rows = [("only", start + timedelta(minutes=i // 3), i, rng.random() < share) for i in range(3000)]  # one source in every part
    rows += [(f"s{i % 7}", start + timedelta(hours=i), i, rng.random() < 0.4) for i in range(60)] + [("null", start, 1, None), (None, start, 1, True), ("gone", start, 1, True)]
    df = spark.createDataFrame(rows, "source string, ts timestamp_ntz, ord long, bad boolean").repartition(5)
    for streak in (3, 9, 40):
        got = {r.source: (r.pulls, r.failure_rate, r.last_success, r.failing) for r in health.source_health(df, "source", "ts", "ord", F.col("bad"), streak).collect()}
        assert got == brute_health(rows, streak)
    assert health.source_health(df.limit(0), "source", "ts", "ord", F.col("bad")).collect() == []


def test_a_run_that_spans_whole_parts(spark):
    start = datetime(2024, 1, 1)
    rows = [("a", start + timedelta(minutes=i), i, 100 <= i < 2900) for i in range(3000)]
    df = spark.createDataFrame(rows, "source string, ts timestamp_ntz, ord long, bad boolean")
    assert health.source_health(df, "source", "ts", "ord", F.col("bad"), 2800).first().failing
    assert not health.source_health(df, "source", "ts", "ord", F.col("bad"), 2801).first().failing


def test_sketches_merge_within_their_bounds(spark):
    rows = spark.range(60_000).select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 28 as int))").alias("ts"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"),
        F.pmod(F.xxhash64("id"), F.lit(9000)).cast("string").alias("content"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1000)).alias("score"),
    )
    days = sketches.daily(rows, "ts", ["source"], F.col("content"), F.col("score"))
    assert days.count() == 56
    week = F.to_date(F.date_trunc("week", "day")).alias("week")
    ranks = [0.1, 0.5, 0.9]
    for by, exact in ((["source"], ["source"]), ([week], [F.to_date(F.date_trunc("week", "ts")).alias("week")]), ([], [])):
        got = sketches.estimates(sketches.merged(days, by), ranks).collect()
        want = rows.groupBy(*exact).agg(F.count("*").alias("n"), F.count_distinct("content").alias("unique"), F.sort_array(F.collect_list("score")).alias("s")).collect()
        assert len(got) == len(want)
        name = (got[0].__fields__ or [""])[0] if by else None
        at = {r[name] if name else None: r for r in want}
        for r in got:
            w = at[r[name] if name else None]
            assert r.n == w.n and abs(r.unique - w.unique) <= 0.05 * w.unique
            for rank, value in zip(ranks, r.quantiles, strict=True):
                low, high = (w.s[min(max(int((rank + d) * w.n), 0), w.n - 1)] for d in (-0.03, 0.03))
                assert low <= value <= high
    none = sketches.estimates(sketches.merged(sketches.daily(rows.limit(1).withColumn("score", F.lit(None).cast("double")), "ts", [], F.col("content"), F.col("score")), []), ranks).first()
    assert (none.n, none.unique, none.quantiles) == (1, 1, None)


def brute_tree(text, size, fan, summarize):
    text = text or ""
    now = [summarize(text[i : i + size]) for i in range(0, max(len(text), 1), size)]
    while len(now) > 1:
        now = [summarize(" ".join(now[i : i + fan])) for i in range(0, len(now), fan)]
    return now[0]


@pytest.mark.parametrize("fan", [2, 3, 8])
def test_summaries_reduce_in_bounded_groups(spark, fan):
    rng = random.Random(fan)
    docs = [(i, "".join(rng.choice("ab cdé. ") for _ in range(rng.choice([0, 1, 9, 10, 11, 95, 400, 1000])))) for i in range(40)] + [(3, "again"), (None, "no id " * 9), (41, None), (42, "x" * 300_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)

    got = sorted((str(r.id), r.summary) for r in summaries.tree(summaries.parts_of(df, "doc_id", "text", 10), lambda c: F.substring(c, 1, 6), fan=fan).collect())
    assert got == sorted((str(d), brute_tree(t, 10, fan, lambda x: x[:6])) for d, t in docs)
    with pytest.raises(ValueError, match="never become one"):
        summaries.tree(df, fan=1)


def test_a_miss_is_computed_once_a_key(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def shout(text):
        calls.add(1)
        return text.upper()

    items = spark.createDataFrame([(i, f"k{i % 3}", f"t{i % 3}") for i in range(300)] + [(900, None, "n"), (901, None, "n"), (902, "hit", "h")], "id long, key string, text string").repartition(6)
    cache = spark.createDataFrame([("hit", "cached"), ("other", "x")], "key string, value string")
    got = {r.id: (r.value, r.cached) for r in state.cache_aside(items, cache, "key", shout(F.col("text"))).collect()}
    assert got == {i: (f"T{i % 3}", False) for i in range(300)} | {900: ("N", False), 901: ("N", False), 902: ("cached", True)}
    assert calls.value == 5

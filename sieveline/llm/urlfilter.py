"""URL filters: host and path rules, then a Bloom filter cascade.

``judge`` splits each URL into host and path and applies the longest rule that fits. What no rule
decides is decided by a blocklist of hosts that is encoded as a cascade of Bloom filters: level 1
holds the listed keys; level 2 the keys of the corpus that level 1 takes for listed though they are
not; level 3 the listed keys that level 2 takes for those; and so on until no key is taken for
another. Because the levels are built against all keys of the corpus, following a key down to the
first level that does not hold it gives its exact membership, and no row is joined to the list.

Everything is DataFrame operations: a filter is an array of 64-bit words, made by ``bit_or`` per word
(aggregated on the map side) and handed to the rows as a scalar subquery. A level has some
``BITS_PER_KEY`` bits a key. No level has more than ``max_bits`` bits: the keys are dealt by a hash into
as many blocks as that takes, each with a cascade of its own, and the rows of each block (written
once, a folder for each) are judged by theirs. One block is the common case.

Defined results: a null URL, or one without ``://``, has an empty host and path; these are keys like
any other. Rows that repeat are judged each by itself. Null keys are not listed. An empty list or an
empty corpus lists nothing.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.session import materialize, shared_path

#: (verdict, host, path): the rules (fixed values).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BITS_PER_KEY = 10
PROBES = 7
#: Bits of the largest level (8 MB as longs); more keys make more blocks.
MAX_BITS = 64 << 20
MAX_LEVELS = 40
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: the host, A-Z lower-cased, up to / ? # or the end; the path up to ? # or the end."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(text, _SPLIT, 1), _UPPER, _LOWER), F.regexp_extract(text, _SPLIT, 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule (rule, verdict) that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _positions(key: Column, level: int, bits: int) -> list[Column]:
    """The bits of a key at a level, by double hashing."""
    m = F.lit(bits).cast("long")
    a, b = (F.pmod(F.xxhash64(F.lit(2 * level + k), key), m) for k in (0, 1))
    return [(a + b * F.lit(i)) % m for i in range(PROBES)]


def _filter(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with one array of the words of the filter that holds ``keys``."""
    own = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits))).alias("p"))
    set_bits = own.select(F.expr("p div 64").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
    zeros = keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
    filled = set_bits.unionByName(zeros).groupBy("w").agg(F.bit_or("b").alias("b"))
    return filled.agg(F.expr("transform(array_sort(collect_list(struct(w, b))), x -> x.b)").alias("words"))


def _holds(words: DataFrame, key: Column, level: int, bits: int) -> Column:
    array, out = words.scalar(), F.lit(True)
    for p in _positions(key, level, bits):
        word = F.element_at(array, (F.floor(p / 64) + 1).cast("int"))
        out = out & (F.expr("0L") != word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))))
    return out


class Cascade:
    """The levels of a cascade, as (words, bits)."""

    def __init__(self, levels: list[tuple[DataFrame, int]]):
        self.levels = levels

    def listed(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that does not hold it tells."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            words, bits = self.levels[i]
            out = F.when(~_holds(words, key, i + 1, bits), F.lit(i % 2 == 1)).otherwise(out)
        return out


def build(universe: DataFrame, listed: DataFrame, bits_per_key: int = BITS_PER_KEY) -> Cascade:
    """The cascade of the listed keys in a universe of distinct keys.

    Both have a column ``key``; listed keys outside the universe do not matter.
    """
    universe = universe.where("key is not null").select("key")
    inside = materialize(universe.join(listed.where("key is not null").select("key"), "key", "left_semi"), "url-listed", compact=True)
    others = universe.join(inside, "key", "left_anti")
    here, there, levels = inside, materialize(others, "url-unlisted", compact=True), []
    for level in range(1, MAX_LEVELS + 1):
        n = here.count()
        if not n:
            return Cascade(levels)
        bits = 64 * max(1, math.ceil(n * bits_per_key / 64))
        words = materialize(_filter(here, level, bits), "url-filter")
        levels.append((words, bits))
        wrong = materialize(there.where(_holds(words, F.col("key"), level, bits)), "url-false-positives", compact=True)
        here, there = wrong, here
    raise RuntimeError(f"the cascade did not end in {MAX_LEVELS} levels")


def judge(
    pages: DataFrame, listed: DataFrame | None = None, page_id: str = "page_id", url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES, bits_per_key: int = BITS_PER_KEY, max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row (page_id, host, path, rule, verdict) per page.

    ``listed`` has a column ``key`` with hosts to block where no rule decides. By default these are
    the hosts of which a rule blocks at least one page of the corpus.
    """
    host, path = host_and_path(F.col(f"`{url}`"))
    parts = pages.select(F.col(f"`{page_id}`").alias("_id"), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))

    def judged(rows: DataFrame, universe: DataFrame, own: DataFrame | None) -> DataFrame:
        if own is None:
            own = rows.where("fit.verdict = 'block'").select(F.col("host").alias("key")).distinct()
        blocked = build(universe, own, bits_per_key).listed(F.col("host"))
        by_list = F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))
        return rows.select(F.col("_id").alias(page_id), "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), by_list).alias("verdict"))

    universe = materialize(parts.select(F.col("host").alias("key")).distinct(), "url-universe", compact=True)
    blocks = max(1, math.ceil(universe.count() * bits_per_key / max_bits))
    if blocks == 1:
        return judged(parts, universe, listed)
    block = lambda key: F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.lit(blocks))
    spark, folder = pages.sparkSession, shared_path(pages.sparkSession, "url-blocks")
    parts.withColumn("block", block("host")).write.partitionBy("block").parquet(folder)
    dealt = spark.read.schema(parts.withColumn("block", block("host")).schema).parquet(folder)
    out = None
    for k in range(blocks):
        one = judged(dealt.where(F.col("block") == k).drop("block"), universe.where(block("key") == k), listed.where(block("key") == k) if listed is not None else None)
        out = one if out is None else out.unionByName(one)
    return out

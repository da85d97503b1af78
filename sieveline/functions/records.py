"""Column expressions for keys, dates, numbers, JSON and small arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RANKING = "struct<feedback:string,topics:array<struct<topic:string,category:string,score:double>>,overall_score:double>"
#: The score of an answer that cannot be read.
UNREADABLE = -0.01
#: Answers that say nothing (fixed values).
INVALID_ANSWERS = ("n/a", "None", "None.")
TRUE_WORDS, FALSE_WORDS = ("yes", "true", "t", "y", "1"), ("no", "false", "f", "n", "0")


def content_id(text: Column) -> Column:
    return F.sha2(text, 256)


def surrogate_key(*parts: Column) -> Column:
    """MD5 of the parts joined by _."""
    return F.md5(F.concat_ws("_", *(p.cast("string") for p in parts)))


def parse_iso(text: Column) -> Column:
    """An ISO-8601 time, with ``Z`` or an offset, or null."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00"))


def pacific(utc: Column) -> Column:
    """A UTC time at Los Angeles' wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit("America/Los_Angeles"), utc)


def date_key(ts: Column, default: str) -> Column:
    """yyyy-MM-dd, or the run's date where there is no time."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(default))


def suffix_date(name: Column) -> Column:
    """The date behind the last ``__`` of a collection's name."""
    return F.try_to_date(F.replace(F.element_at(F.split(name, "__"), -1), F.lit("_"), F.lit("-")), "yyyy-MM-dd")


def falsy(value: Column, default: float) -> Column:
    """The value, or the default where it is null or zero."""
    return F.coalesce(F.nullif(value, F.lit(0.0)), F.lit(default))


def blended(user_rating: Column, relevance: Column) -> Column:
    return 0.8 * user_rating + 0.2 * relevance


def minutes(seconds: Column) -> Column:
    return F.format_number(seconds / 60, 2)


def parse_json(text: Column, schema: str) -> Column:
    """JSON without tabs, by schema; null if it cannot be read."""
    return F.from_json(F.replace(text, F.lit("\t"), F.lit("")), schema)


def ranking(answer: Column) -> Column:
    """An answer's topics, categories (name, score; a missing score is 1), overall score and feedback."""
    own = parse_json(answer, RANKING)
    pairs = lambda field: F.transform(
        F.coalesce(own["topics"], F.array().cast("array<struct<topic:string,category:string,score:double>>")),
        lambda t: F.struct(t[field].alias("name"), falsy(t["score"], 1.0).alias("score")),
    )
    return F.struct(
        pairs("topic").alias("topics"), pairs("category").alias("categories"),
        F.coalesce(own["overall_score"], F.lit(UNREADABLE)).alias("overall_score"), F.coalesce(own["feedback"], F.lit("")).alias("feedback"),
    )


def top_pairs(pairs: Column, k: int = 3) -> Column:
    """The ``k`` pairs (name, score) of highest score; ties keep their order. Null gives none."""
    placed = F.transform(F.coalesce(pairs, F.array().cast("array<struct<name:string,score:double>>")), lambda p, i: F.struct((-p.score).alias("s"), i.alias("i"), p.alias("p")))
    return F.transform(F.slice(F.array_sort(placed), 1, k), lambda x: x.p)


def labels(pairs: Column, limit: int = 20) -> Column:
    """Names of pairs as labels: commas become blanks, at most ``limit`` characters."""
    return F.transform(pairs, lambda p: F.substring(F.replace(p["name"], F.lit(","), F.lit(" ")), 1, limit))


def thresholds(text: Column) -> Column:
    """``"a:1,b:2"`` as a map; malformed parts are skipped, of repeated names the last counts."""
    parts = F.filter(F.split(text, ","), lambda p: p.rlike(r"^\s*[^:]+:\s*-?\d+(\.\d+)?\s*$"))
    names = F.transform(parts, lambda p: F.trim(F.split_part(p, F.lit(":"), F.lit(1))))
    values = F.transform(parts, lambda p: F.trim(F.split_part(p, F.lit(":"), F.lit(2))).cast("double"))
    last = F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda x, i: F.array_position(F.reverse(names), x["n"]) == F.size(names) - i)
    return F.map_from_entries(last)


def to_bool(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False).otherwise(
        F.raise_error(F.concat(F.lit("not a truth value: "), F.coalesce(text, F.lit("null")))).cast("boolean")
    )

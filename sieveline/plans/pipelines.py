"""Stage orders of the sources, as one lazy plan each.

Items are rows of (item_id, source, list_name, title, text, ordinal), ``vectors`` those of (vec_id,
embedding, label), where the label stands for a user's rating. Providers come after all filters,
so that they see as few rows as possible.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.records import ranking, top_pairs
from sieveline.operators import dedup, providers, scoring


@dataclass
class Config:
    """Thresholds and providers of a run."""

    least: float = 4.0
    k: int | None = None
    topics: int = 3
    rank_least: float = 4.0
    summarize: providers.Provider = field(default_factory=lambda: providers.lead_summary)
    rank: providers.Provider = field(default_factory=lambda: providers.length_ranking)


def fresh(items: DataFrame, seen: DataFrame, scores: DataFrame | None = None) -> DataFrame:
    """Unseen items, with ``relevance`` where scores (item_id, relevance) are given: -1 for those without one."""
    out = dedup.unseen(items, seen, ["source", "list_name", "item_id"])
    if scores is not None:
        out = out.join(scores.select("item_id", "relevance"), "item_id", "left").withColumn("relevance", F.coalesce("relevance", F.lit(-1.0)))
    return out


def summarized(items: DataFrame, config: Config) -> DataFrame:
    return items.withColumn("summary", config.summarize(F.col("text")))


def ranked(items: DataFrame, config: Config, text: Column, relevance: Column | None = None) -> DataFrame:
    """With topics, categories and rate; what is not worth ranking has the rate -0.02."""
    skip = scoring.rank_skip(relevance if relevance is not None else F.lit(-1.0), text, True, config.rank_least)
    answer = ranking(F.when(~skip, config.rank(text)))
    none = F.array().cast("array<struct<name:string,score:double>>")
    return (
        items.withColumn("_a", answer)
        .withColumn("topics", F.when(skip, none).otherwise(top_pairs(F.col("_a.topics"), config.topics)))
        .withColumn("categories", F.when(skip, none).otherwise(top_pairs(F.col("_a.categories"), config.topics)))
        .withColumn("rate", F.when(skip, F.lit(-0.02)).otherwise(F.col("_a.overall_score"))).drop("_a")
    )


def rss(items: DataFrame, seen: DataFrame, scores: DataFrame, config: Config = Config(k=1)) -> DataFrame:
    """Unseen, scored, filtered to the best, summarised; never ranked, so rated -1."""
    kept = fresh(items, seen, scores)
    kept = scoring.filter_top(kept, "relevance", "ordinal", config.k or 3, config.least)
    return summarized(kept, config).withColumn("rate", F.lit(-1.0))


def twitter(items: DataFrame, seen: DataFrame, scores: DataFrame, limits: DataFrame, config: Config = Config()) -> DataFrame:
    """Unseen, scored, filtered by their list, ranked; rates count in hundredths."""
    kept = scoring.filter_by_list(fresh(items, seen, scores), limits, "list_name", "relevance", config.least)
    return ranked(kept, config, F.col("text"), F.col("relevance")).withColumn("rate", F.col("rate") * 100)


def reddit(items: DataFrame, seen: DataFrame, scores: DataFrame, limits: DataFrame, config: Config = Config()) -> DataFrame:
    """Unseen, scored, filtered by their list, summarised, ranked; rates count in hundredths."""
    kept = scoring.filter_by_list(fresh(items, seen, scores), limits, "list_name", "relevance", config.least)
    text = F.concat_ws(" ", "list_name", "title", "summary")
    return ranked(summarized(kept, config), config, text, F.col("relevance")).withColumn("rate", F.col("rate") * 100)


def article(items: DataFrame, seen: DataFrame, config: Config = Config()) -> DataFrame:
    """Unseen, summarised, ranked by their summary."""
    return ranked(summarized(fresh(items, seen), config), config, F.col("summary"))


def weekly(items: DataFrame, relevance: DataFrame, k: int = 10, pre: float = 4.0, post: float = 4.5) -> DataFrame:
    """Rated or noted items, blended with their relevance, the best ``k`` of them."""
    kept = items.where((F.col("user_rating") >= pre) | (F.coalesce("take_aways", F.lit("")) != ""))
    scored = kept.join(relevance, "item_id", "left").withColumn("relevance", F.coalesce("relevance", F.lit(-1.0)))
    return scoring.weekly_filter(scored, "user_rating", "relevance", "ordinal", k, post)


def distribute(snapshots: DataFrame, run_day: str, before: DataFrame, days: int = 30) -> DataFrame:
    """The latest rated version of each page in the trailing days, marked new or updated against the state before."""
    from sieveline.sources.files import trailing_days

    rated = trailing_days(snapshots, "ds", run_day, days).where("user_rating is not null")
    return dedup.split_changes(dedup.latest(rated, "item_id", "last_edited_time", "ordinal"), before, "item_id", "user_rating")


def todos(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Take-aways to act on: not from TODO or Journal pages, not tagged for a deep dive, not seen in this version."""
    own = items.where(~F.col("source").isin("TODO", "Journal") & ~F.coalesce(F.array_contains("tags", "action:deepdive"), F.lit(False)))
    own = own.where(F.length(F.coalesce("take_aways", F.lit(""))) > 0)
    return dedup.unseen_versions(own, seen, "item_id", "last_edited_time")


def deepdives(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Pages tagged for a deep dive that were never done."""
    return dedup.unseen(items.where(F.array_contains("tags", "action:deepdive")), seen, ["item_id"])

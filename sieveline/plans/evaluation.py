"""Evaluation of deduplication over a dataset of posts: base texts, updates of several kinds, and what of an update should stay.

Every update is cut into chunks and compared with the chunks of its own base; chunks that resemble none are kept. A kept chunk is
right if it overlaps the ground truth. Chunks meet by their post only, so the work grows with the posts and with the
square of one post's chunks, and no pair is kept: a chunk that has found one like it is done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions import vectors as V
from sieveline.functions.text import containment, tokens
from sieveline.operators import chunking, evaluate, providers
from sieveline.session import materialize

#: Similarity from which a chunk is a duplicate (fixed value).
DUPLICATE = 0.85


def _chunks(texts: DataFrame, embed: providers.Provider, name: str, size: int, overlap: int) -> DataFrame:
    """Rows (vec_id, post_id, dup_type, chunk_id, chunk_text, embedding) of texts (post_id, dup_type, text)."""
    keyed = texts.select(F.to_json(F.struct("post_id", "dup_type")).alias("key"), "text")
    own = chunking.chunk(keyed, "key", source=None, size=size, overlap=overlap)
    parts = F.from_json("article_id", "post_id string, dup_type string")
    rows = own.select(F.monotonically_increasing_id().alias("vec_id"), parts.alias("p"), "chunk_id", "chunk_text", embed(F.col("chunk_text")).alias("embedding"))
    return materialize(rows.select("vec_id", "p.post_id", "p.dup_type", "chunk_id", "chunk_text", "embedding"), name)


def evaluate_posts(
    posts: DataFrame, embed: providers.Provider = providers.hashed_embedding, threshold: float = DUPLICATE, overlap: float = evaluate.OVERLAP, compat: bool = False, size: int = 1024, shared: int = 128
) -> DataFrame:
    """Rows (post_id, dup_type, base_chunks, update_chunks, unique_chunks, duplicate_chunks, dedup_rate, tp, fp, fn, tn, precision, recall, f1, accuracy).

    ``posts``: post_id, kind (base, update, ground_truth), dup_type (null for a base), text, as ``files.read_dataset`` gives them; only
    complete triples count. Only kept chunks are judged, so nothing is missed or rightly dropped. With ``compat`` a chunk
    that the base holds word for word is the chunk itself and no duplicate of it.
    """
    own = posts.where("post_id is not null")
    base = own.where("kind = 'base'").select("post_id", F.lit(None).cast("string").alias("dup_type"), "text")
    update, truth = (own.where(f"kind = '{k}' and dup_type is not null").select("post_id", "dup_type", "text") for k in ("update", "ground_truth"))
    update = update.join(base.select("post_id").distinct(), "post_id", "left_semi").join(truth.select("post_id", "dup_type").distinct(), ["post_id", "dup_type"], "left_semi")
    stored, new = (_chunks(t, embed, n, size, shared) for t, n in ((base, "base-chunks"), (update, "update-chunks")))
    there = stored.where("embedding is not null").select(F.col("post_id").alias("_post"), F.col("chunk_id").alias("_chunk"), F.col("embedding").alias("_base"))
    alike = (F.col("post_id") == F.col("_post")) & (V.cosine(F.col("embedding"), F.col("_base")) >= threshold - 1e-12)
    alike = alike & (F.col("chunk_id") != F.col("_chunk")) if compat else alike
    hit = materialize(new.where("embedding is not null").join(there, alike, "left_semi").select(F.col("vec_id").alias("_hit")), "duplicate-chunks", compact=True)
    wanted = truth.select(F.col("post_id").alias("_post"), F.col("dup_type").alias("_type"), tokens(F.coalesce("text", F.lit(""))).alias("_tokens"))
    judged = new.join(hit, F.col("vec_id") == F.col("_hit"), "left").join(wanted, (F.col("post_id") == F.col("_post")) & (F.col("dup_type") == F.col("_type")))
    judged = materialize(judged.select("post_id", "dup_type", F.col("_hit").isNull().alias("kept"), (containment(tokens(F.col("chunk_text")), F.col("_tokens")) >= overlap).alias("wanted")), "judged-chunks", compact=True)
    by = ["post_id", "dup_type"]
    sizes = judged.groupBy(*by).agg(F.count("*").alias("update_chunks"), F.count_if("kept").alias("unique_chunks"))
    bases = stored.groupBy("post_id").agg(F.count("*").alias("base_chunks"))
    rates = evaluate.confusion(judged.where("kept"), F.col("kept"), F.col("wanted"), by)
    zero = {c: 0 for c in ("base_chunks", "update_chunks", "unique_chunks", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "accuracy")}
    rows = update.select(*by).distinct().join(sizes, by, "left").join(bases, "post_id", "left").join(rates, by, "left").fillna(zero)
    dups = F.col("update_chunks") - F.col("unique_chunks")
    rate = F.coalesce(F.try_divide(dups, F.col("update_chunks")), F.lit(0.0))
    return rows.select(*by, "base_chunks", "update_chunks", "unique_chunks", dups.alias("duplicate_chunks"), rate.alias("dedup_rate"), "tp", "fp", "fn", "tn", "precision", "recall", "f1", "accuracy")


def by_type(rows: DataFrame) -> DataFrame:
    """Rows (dup_type, posts, and unweighted means of the rates) over the posts of each type."""
    return rows.groupBy("dup_type").agg(F.count("*").alias("posts"), *(F.avg(c).alias(c) for c in ("dedup_rate", "precision", "recall", "f1", "accuracy")))

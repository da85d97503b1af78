"""Containment of token sets: which texts hold most of which others.

The overlap of two texts is the number of distinct tokens they share over the smaller of both sets (0 if one is empty).

``containing`` finds all pairs of a threshold or more by an inverted index. Tokens are ordered by how many documents have them,
rarest first. If a pair reaches the threshold, so many tokens of the smaller set are shared that one of its rarest
``size - ceil(threshold * size) + 1`` must be: only these prefixes are joined with the whole sets of the other side, and what
meets is verified on whole sets. Both sides are shuffled by token; no text goes through the driver, and frequent tokens
are in few prefixes.

``best_containment`` wants the best item of each document, however small the overlap. Documents that the index finds have it
from there; the rest are compared with all of the truth in blocks: both sides are dealt to (block, slice), where a block
holds a bounded share of the truth's tokens and a slice a bounded share of the documents', and each such group counts shared tokens
over the block's postings. A truth of one block needs no index: every document is dealt once in any case. Rows are told apart by a
number that is written once before all passes, so the result has a row for each document row, whatever its id and whatever the
size of a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.text import tokens
from sieveline.session import materialize

#: Overlap from which documents find their items by the index: below it prefixes are most of a set.
LEAST = 0.8
#: Bytes of tokens of the truth in one block, and of documents in one slice of it.
BLOCK_BYTES = 32 << 20


def token_sets(df: DataFrame, id_col: str, text: str, name: str) -> DataFrame:
    """Rows (row, id, tokens, size) with a number for each row, written once."""
    own = df.select(F.col(f"`{id_col}`").alias("id"), tokens(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("tokens"))
    return materialize(own.select(F.monotonically_increasing_id().alias("row"), "id", "tokens", F.size("tokens").alias("size")), name)


def _ordered(each: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Rows (row, size, known) with the tokens of ``each`` (row, token, df) from the rarest on."""
    known = each.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("known"))
    joined = sets.select("row", "id", "size").join(known, F.col("row") == F.col("_row"))
    return materialize(joined.select("row", "id", "size", F.transform("known", lambda x: x["token"]).alias("known")), name)


def _pairs(docs: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """Rows (row, id, item, overlap) of the token sets that reach the threshold."""
    vocabulary = truth.select(F.explode("tokens").alias("token")).distinct()
    met = docs.select("row", F.explode("tokens").alias("token")).join(vocabulary, "token", "left_semi")
    often = met.groupBy("token").agg(F.count("*").alias("df"))
    order = materialize(vocabulary.join(often, "token", "left").select("token", F.coalesce("df", F.lit(0)).alias("df")), "token-order", compact=True)
    own = _ordered(met.join(order, "token"), docs, "known-tokens")
    items = _ordered(truth.select("row", F.explode("tokens").alias("token")).join(order, "token"), truth, "item-tokens")
    items = items.select(F.col("row").alias("irow"), F.col("id").alias("item"), F.col("size").alias("isize"), F.col("known").alias("iknown"))

    def prefix(df: DataFrame, size: str, known: str) -> DataFrame:
        # tokens that the other side does not have at all are the rarest
        n = F.col(size) - F.ceil(F.lit(threshold) * F.col(size) - 1e-9) + 1 - (F.col(size) - F.size(known))
        return df.withColumn("token", F.explode(F.slice(known, F.lit(1), F.greatest(n, F.lit(0)).cast("int"))))

    a = prefix(items, "isize", "iknown").select("irow", "isize", "token").join(own.select("row", "size", F.explode("known").alias("token")), "token").where("isize <= size")
    b = prefix(own, "size", "known").select("row", "size", "token").join(items.select("irow", "isize", F.explode("iknown").alias("token")), "token").where("size < isize")
    met = a.select("row", "irow").union(b.select("row", "irow")).distinct()
    found = met.join(own, "row").join(items, "irow")
    shared = F.size(F.array_intersect("known", "iknown")) / F.least("size", "isize")
    return found.select("row", "id", "item", shared.alias("overlap")).where(F.col("overlap") >= threshold)


def containing(docs: DataFrame, truth: DataFrame, doc_id: str, item_id: str, text: str = "text", threshold: float = LEAST) -> DataFrame:
    """Rows (doc_id, item_id, overlap): all pairs with an overlap of ``threshold`` (above 0) or more, one for each pair of rows."""
    if threshold <= 0:
        raise ValueError(f"the threshold is {threshold}: pairs that share nothing are not found")
    found = _pairs(token_sets(docs, doc_id, text, "document-tokens"), token_sets(truth, item_id, text, "truth-tokens"), threshold)
    return found.select(F.col("id").alias(doc_id), F.col("item").alias(item_id), "overlap")


def _best_of_block(key: tuple, docs: pa.Table, items: pa.Table) -> pa.Table:
    """The best item of a block for each document of a slice: the largest overlap, then the smallest id; none and 0 without items."""
    best, over = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows)
    items = items.sort_by("item")
    names, places = items.column("item"), {}
    for k, own in enumerate(items.column("tokens").to_pylist()):
        for t in own:
            places.setdefault(t, []).append(k)
    places = {t: np.array(p) for t, p in places.items()}
    sizes = items.column("size").to_numpy()
    for i in range(docs.num_rows if items.num_rows else 0):
        own = docs.column("tokens")[i].as_py()
        hits = [places[t] for t in own if t in places]
        if hits:
            least = np.minimum(sizes, len(own))
            share = np.divide(np.bincount(np.concatenate(hits), minlength=len(sizes)), least, out=np.zeros(len(sizes)), where=least > 0)
            best[i] = np.argmax(share)
            over[i] = share[best[i]]
    item = names.take(pa.array(best)) if items.num_rows else pa.nulls(docs.num_rows, names.type)
    return pa.table([docs.column("row"), item, pa.array(over)], names=["row", "item", "overlap"])


def _in_blocks(own: DataFrame, truth: DataFrame, blocks: int, slices_: int) -> DataFrame:
    """Rows (row, item, overlap): the best item of each block of the truth for each of the rows (row, slice, tokens)."""
    theirs = truth.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices_ - 1))).alias("slice"), F.col("id").alias("item"), "tokens", "size")
    dealt = own.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1))).alias("block"), "slice", "row", "tokens")
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((own, "row"), (truth, "id"))]
    return dealt.groupBy("block", "slice").cogroup(theirs.groupBy("block", "slice")).applyInArrow(_best_of_block, f"row {kinds[0]}, item {kinds[1]}, overlap double")


def _parts(size: int | None, part: int) -> int:
    return max(1, -(-(size or 0) // part))


def best_containment(docs: DataFrame, truth: DataFrame, doc_id: str, item_id: str, text: str = "text", block_bytes: int = BLOCK_BYTES, least: float = LEAST) -> DataFrame:
    """Rows (doc_id, item_id, overlap): for each document row the truth text that contains most of it, or that it contains.

    Ties go to the smaller item, so a document that shares nothing has the smallest item and 0; null texts are empty, items with
    a null id are left out, and without any items the item is null. Item ids are numbers.
    """
    items = token_sets(truth.where(F.col(f"`{item_id}`").isNotNull()), item_id, text, "truth-tokens")
    blocks = _parts(items.agg(F.sum(F.size("tokens") * 16 + 64).cast("long")).first()[0], block_bytes)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    slices_ = max(_parts(docs.agg(F.sum(F.octet_length(body)).cast("long")).first()[0], block_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    if blocks == 1:  # each row meets all items in one group and needs no number to be known by
        own = docs.select(F.col(f"`{doc_id}`").alias("row"), F.pmod(F.monotonically_increasing_id(), F.lit(slices_)).alias("slice"), tokens(body).alias("tokens"))
        found = _in_blocks(own, items, blocks, slices_)
        return found.select(F.col("row").alias(doc_id), F.col("item").alias(item_id), "overlap")
    own = token_sets(docs, doc_id, text, "document-tokens")
    order = F.struct("overlap", -F.col("item"))
    best = lambda df: df.groupBy("row").agg(F.max_by(F.struct("item", "overlap"), order).alias("b")).select("row", "b.item", "b.overlap")
    indexed = materialize(best(_pairs(own, items, least)), "containing-items", compact=True)
    rest = own.join(indexed, "row", "left_anti").withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices_)))
    found = indexed.unionByName(best(_in_blocks(rest, items, blocks, slices_))).withColumnRenamed("row", "_row")
    joined = own.join(found, F.col("row") == F.col("_row"), "left")
    return joined.select(F.col("id").alias(doc_id), F.col("item").alias(item_id), F.coalesce("overlap", F.lit(0.0)).alias("overlap"))

"""Text search: the documents that hold most of each query's words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of one broadcast incidence matrix.
CELLS = 32 << 20
#: Scores that a worker holds at a time.
SCORES = 1 << 20
_WHITE = re.compile(r"\s+", re.ASCII)


def word_set(text: str | None) -> set[str]:
    """The distinct lower-cased tokens between (ASCII) white space."""
    return set(_WHITE.split(text.lower())) - {""} if text else set()


def search(queries: DataFrame, docs: DataFrame, k: int = 3, query_id: str = "item_id", doc_id: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """Rows (query_id, doc_id, score, rn): the ``k`` documents with the largest share of a query's distinct tokens.

    Ties go to the smaller id; documents that share nothing are not found. Ids are whole numbers.
    The query set goes out in broadcast blocks of at most ``cells`` bytes; every task keeps ``k``
    documents a query and scores a slice of rows at a time, so that what is shuffled is ``k`` rows a query and task.
    """
    own = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("d"), F.col(text).cast("string").alias("t"))

    def block(rows: list[tuple[int, set[str]]]) -> DataFrame:
        words = {t: i for i, t in enumerate(dict.fromkeys(t for _, s in rows for t in s))}
        holds = np.zeros((len(words) + 1, len(rows)), np.uint8)
        for j, (_, s) in enumerate(rows):
            holds[[words[t] for t in s], j] = 1
        shared = docs.sparkSession.sparkContext.broadcast((words, holds, np.array([q for q, _ in rows], np.int64), np.array([max(len(s), 1) for _, s in rows])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, holds, ids, sizes = shared.value
            score, who = np.zeros((len(ids), k)), np.full((len(ids), k), np.iinfo(np.int64).max)
            step = max(1, SCORES // len(ids))
            for batch in (whole.slice(at, step) for whole in batches for at in range(0, whole.num_rows, step)):
                theirs = batch.column(0).to_numpy()
                found = np.zeros((len(ids), len(theirs)))
                for j, value in enumerate(batch.column(1).to_pylist()):
                    known = [words[t] for t in word_set(value) & words.keys()]
                    found[:, j] = holds[known].sum(axis=0, dtype=np.int64) / sizes
                both = np.concatenate([score, found], axis=1)
                names = np.concatenate([who, np.broadcast_to(theirs, found.shape)], axis=1)
                best = np.lexsort((names, -both), axis=1)[:, :k]
                score, who = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)
            row, column = np.nonzero(score)
            yield pa.RecordBatch.from_arrays([pa.array(ids[row]), pa.array(who[row, column]), pa.array(score[row, column])], names=["q", "d", "score"])

        return own.mapInArrow(run, "q long, d long, score double")

    parts, rows, words = [], [], set()
    for row in queries.where(F.col(query_id).isNotNull()).select(F.col(query_id).cast("long").alias("q"), F.col(text).cast("string").alias("t")).toLocalIterator():
        tokens = word_set(row.t)
        if rows and (len(rows) + 1) * len(words | tokens) > cells:
            parts.append(block(rows))
            rows, words = [], set()
        rows.append((row.q, tokens))
        words |= tokens
    if rows:
        parts.append(block(rows))
    out = docs.sparkSession.createDataFrame([], "q long, d long, score double")
    for p in parts:
        out = out.unionByName(p)
    ranked = out.withColumn("rn", F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "d"))).where(F.col("rn") <= k)
    return ranked.select(F.col("q").alias("query_id"), F.col("d").alias("doc_id"), "score", "rn")


def context(hits: DataFrame, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (query_id, context): the found texts of each query, best first, for an answering provider."""
    joined = hits.join(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), "doc_id")
    each = joined.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rn", "_t"))).alias("s"))
    return each.select("query_id", F.array_join(F.transform("s", lambda x: x["_t"]), "\n\n").alias("context"))

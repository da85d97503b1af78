"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet in the shared folder and gives the next stage what it reads back. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import decontam, linededup, packing, quality, simhash
from sieveline.session import Tables, materialize, table

TOKENIZER = "word_bpe_49k.json"
#: Documents whose fingerprints are apart are near duplicates if the sets of their runs of words have this Jaccard similarity or more.
NEAR_WORDS = 5
NEAR_SIMILARITY = 0.8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts fail the base rules; rows are judged one by one, so repeated ones share their verdict; a document
    without an id or label is judged like any other. Without enough labels only the base rules apply.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Widespread lines go, but for the largest id that holds them; n_chars, where there is one, follows the text.

    A null text becomes an empty one, with n_chars 0. Rows that share an id count as one document and lose the same lines; a null
    id counts as none. No document goes, not even one that lost all of its lines.
    """
    out = linededup.dedup_lines(docs, counts=False)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id.

    Near are fingerprints within two bits (operator 6's balls), and sets of runs of NEAR_WORDS words that are NEAR_SIMILARITY alike.

    Documents without words are copies of each other. Rows that share the smallest id of their group all stay; documents without an
    id stay only if none of their group has one.
    """
    return simhash.representatives(docs, size=NEAR_WORDS, similarity=NEAR_SIMILARITY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more of the words stand in benchmark passages go.

    Null and empty texts have no words and stay; rows are judged one by one; items that are null or without words hit nothing.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of power-of-two lengths with their token ids, a row for each piece of a document.

    A null or empty text is the end id alone; rows that share an id are packed each by itself. An empty table gives no rows.
    """
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality rules", keep_quality),
    ("line dedup", drop_lines),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The model, the fingerprints and the tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Tables(spark) as own:
        for name, stage in STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            own.clear(keep=docs)
        return STAGES[-1][1](spark, docs, sf_dir)

"""Incremental intake of articles: what arrived since the last run is cleaned, told from what was seen before, summarised and ranked.

    spark-submit jobs/article_intake.py --articles in/articles --output out/articles --checkpoint out/articles-log [--config jobs/article_intake.json]

Reads Parquet files of (doc_id, text, lang, source), below a folder or as a pattern names them, as a file stream and ends
when all that is there has been taken; the checkpoint knows which files were. Every row of the input is in the output, under its ``status``:

* ``new``: the first article with its content; with a summary, topics and a rate,
* ``copy``: its content is that of ``original``, which came before (in an earlier batch, or with a smaller id in the same),
* ``rejected``: it has no id or no text, as ``reason`` says.

Content is the text with runs of line breaks as one and without white space at its ends; its SHA-256 is ``content_id``. An
article that is delivered again, in the same batch or a later one, is a copy of itself.

The output is partitioned by batch and status. A batch that is run again after a crash writes its own partition anew and
looks for seen content only in batches before it, so it comes out the same. The output belongs to its checkpoint: one
without the other is an error. The copies of a text, however many, are a row a task in the aggregation that finds the
first; rejected rows take no part in joins, and texts are not shuffled: summaries are made where texts are read, of copies too.
"""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobs import settings
from sieveline.functions.text import refine
from sieveline.operators import providers
from sieveline.plans import pipelines

log = logging.getLogger("jobs.article_intake")

ARTICLE = "doc_id long, text string, lang string, source string"
ROW = (
    "doc_id long, source string, lang string, content_id string, original long, reason string, n_chars long, summary string, "
    "topics array<struct<name:string,score:double>>, rate double"
)
STORED = f"{ROW}, batch long, status string"


@dataclass(frozen=True)
class Config:
    files_per_batch: int = 200
    sentences: int = 2
    topics: int = 3


def judge(articles: DataFrame, known: DataFrame, config: Config = Config()) -> DataFrame:
    """The rows of a batch as ROW with ``status``, given the contents (content_id, original) of the batches before.

    ``articles`` has ARTICLE and, as file_path and row_index, the place of each row, which tells rows with the same id apart.
    """
    text = refine(F.coalesce("text", F.lit("")))
    rows = articles.select("doc_id", "source", "lang", text.alias("text"), F.struct("doc_id", "file_path", "row_index").alias("place"))
    reason = F.when(F.col("doc_id").isNull(), F.lit("no id")).when(F.col("text") == "", F.lit("no text"))
    rows = rows.withColumn("reason", reason).withColumn("n_chars", F.length("text").cast("long"))
    good = rows.where("reason is null").withColumn("content_id", F.sha2("text", 256))
    firsts = good.groupBy("content_id").agg(F.min("place").alias("first"))
    seen = known.select(F.col("content_id").alias("_seen"), F.col("original").alias("_original"))
    origins = firsts.join(seen, F.col("content_id") == F.col("_seen"), "left")
    origins = origins.select(F.col("content_id").alias("_content"), F.coalesce("_original", "first.doc_id").alias("original"), F.when(F.col("_seen").isNull(), F.col("first")).alias("_first"))
    plan = pipelines.Config(summarize=lambda t: providers.lead_summary(t, config.sentences, limit=2**31 - 1), topics=config.topics)
    short = pipelines.summarized(good, plan).drop("text")
    placed = short.join(origins, F.col("content_id") == F.col("_content"))
    placed = placed.withColumn("status", F.when(F.col("place") == F.col("_first"), "new").otherwise("copy"))
    of_new = lambda df, *columns: df.withColumns({c: F.when(F.col("status") == "new", F.col(c)) for c in columns})
    done = of_new(pipelines.ranked(of_new(placed, "summary"), plan, F.col("summary")), "topics", "rate")
    rest = rows.where("reason is not null").withColumn("status", F.lit("rejected"))
    return done.unionByName(rest, allowMissingColumns=True).select(*StructType.fromDDL(ROW).names, "status")


def read(spark: SparkSession, output: str) -> DataFrame:
    """All that was taken in so far."""
    return spark.read.schema(STORED).parquet(output) if settings.exists(spark, f"{output}/batch=*") else spark.createDataFrame([], STORED)


def run(spark: SparkSession, articles: str, output: str, checkpoint: str, config: Config = Config()) -> DataFrame:
    """Take in what is new; the whole output as it stands then."""
    articles, output, checkpoint = (p.rstrip("/") for p in (articles, output, checkpoint))
    committed = settings.exists(spark, f"{checkpoint}/commits/[0-9]*")
    # a first run that broke off within its first batch has an offset, perhaps output, and no commit
    if committed != settings.exists(spark, f"{output}/batch=*") and (committed or not settings.exists(spark, f"{checkpoint}/offsets/[0-9]*")):
        raise ValueError(f"{output} and {checkpoint} do not belong together: one of them is missing")

    taken: list[int] = []

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        known = read(session, output).where((F.col("status") == "new") & (F.col("batch") < number)) if number else session.createDataFrame([], STORED)
        path = f"{output}/batch={number}"
        judge(batch, known.select("content_id", "original"), config).write.mode("overwrite").partitionBy("status").parquet(path)
        written = session.read.schema(f"{ROW}, status string").parquet(path).groupBy("status").count().collect()  # three rows at most
        taken.append(sum(r["count"] for r in written))
        log.info("batch %d: wrote %s to %s", number, {r["status"]: r["count"] for r in written}, path)

    stream = spark.readStream.schema(ARTICLE).option("maxFilesPerTrigger", config.files_per_batch).parquet(articles)
    stream = stream.select("*", "_metadata.file_path", "_metadata.row_index")
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d rows in %d batches from %s", sum(taken), len(taken), articles)
    return read(spark, output)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("articles", "output", "checkpoint"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--config")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName("article-intake").getOrCreate()
    try:
        run(spark, args.articles, args.output, args.checkpoint, settings.load(spark, args.config, Config))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

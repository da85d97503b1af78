"""Sinks: JSON by run, vectors by day, Markdown by category, and state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.session import disk_path
from sieveline.sinks.notes import NoteFiles


def write_run(df: DataFrame, folder: str, run_id: str) -> None:
    """JSON lines under ``run_id=...``; a run that is repeated replaces its own output only."""
    df.write.mode("overwrite").json(f"{folder}/run_id={run_id}")


def append_new(df: DataFrame, known: DataFrame, key: str, path: str) -> None:
    """Append the rows whose key is not known yet, each key once (insert, do nothing on conflict)."""
    df.join(known.select(key), key, "left_anti").dropDuplicates([key]).write.mode("append").parquet(path)


def split_failures(df: DataFrame, error: str) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error: the second are for the dead-letter table."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())


def dead_letters(failed: DataFrame, stage: str, item: str, error: str, attempts: int, run_ts: str) -> DataFrame:
    return failed.select(
        F.col(item).cast("string").alias("item_id"), F.lit(stage).alias("stage"), F.col(error).alias("reason"), F.lit(attempts).alias("attempts"),
        F.lit(run_ts).cast("timestamp").alias("failed_at"),
    )


def markdown_note(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows (*keep, file_name, note) from title, url, source, tags, rating, summary, created_time."""
    name = F.concat(F.date_format("created_time", "yyyy-MM-dd"), F.lit(" "), F.substring(F.regexp_replace("title", r'[\\/:*?"<>|#^\[\]]+', " "), 1, 80), F.lit(".md"))
    quoted = F.transform("tags", lambda t: F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit("'")), F.lit('"')))
    head = F.format_string(
        "---\ntitle: %s\nsource: %s\nurl: %s\ndate: %s\nrating: %s\ntags: [%s]\n---\n",
        F.to_json(F.struct("title")).substr(F.lit(10), F.length(F.to_json(F.struct("title"))) - 10), F.col("source"), F.col("url"),
        F.date_format("created_time", "yyyy-MM-dd"), F.coalesce(F.col("rating").cast("string"), F.lit("")), F.array_join(quoted, ", "),
    )
    return df.select(*(keep or []), name.alias("file_name"), F.concat(head, F.lit("\n# "), "title", F.lit("\n\n"), F.coalesce("summary", F.lit("")), F.lit("\n")).alias("note"))


#: Lines of an inbox note's front matter (fixed values) and the columns they come from.
INBOX_FIELDS = {
    "created_at": "created_time", "rating": "rating", "user_rating": "user_rating", "alias": "alias", "to": "to", "source": "source", "list_name": "list_name",
    "notion url": "url", "topic": "topics", "category": "categories", "take aways": "take_aways",
}


def inbox_note(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows (*keep, file_name, note) of items for an inbox: all INBOX_FIELDS as front matter, then tags, a link to the inbox and the body.

    Missing columns and null values leave their line empty, arrays are joined by commas. The file is named by source, first category
    and title, without what file names cannot hold.
    """
    def value(c: str):
        if c not in df.columns:
            return F.lit("")
        kind = df.schema[c].dataType.typeName()
        own = F.date_format(c, "yyyy-MM-dd") if kind in ("timestamp", "timestamp_ntz", "date") else F.array_join(F.array_compact(c), ", ") if kind == "array" else F.col(c).cast("string")
        return F.coalesce(F.regexp_replace(own, r"\s*\n\s*", " "), F.lit(""))

    first = F.coalesce(F.try_element_at("categories", F.lit(1)), F.lit("")) if "categories" in df.columns else F.lit("")
    plain = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r'[\\/:*?"<>|#^\[\]\s]+', " "))
    name = F.concat(F.concat_ws("_", plain(F.col("source")), plain(first), F.substring(plain(F.col("title")), 1, 80)), F.lit(".md"))
    head = F.concat(*(F.concat(F.lit(f"{k}: "), value(c), F.lit("\n")) for k, c in INBOX_FIELDS.items()))
    text = F.concat(F.lit("---\n"), head, F.lit("---\n\nTags:: #notion/toread\nRefs:: [[Notion ToRead - MOC]]\n\n"), F.coalesce("body", F.lit("")), F.lit("\n"))
    return df.select(*(keep or []), name.alias("file_name"), text.alias("note"))


def append_lines(rows: DataFrame, path: str, known: DataFrame | None = None, key: str = "value") -> None:
    """Append references or articles as lines of text; those whose key is known already are left out, each key once."""
    new = rows if known is None else rows.join(known.select(key).distinct(), key, "left_anti")
    new.dropDuplicates([key]).select("value").write.mode("append").text(path)


def write_notes(df: DataFrame, path: str, category: str, known: DataFrame | None = None, folders: bool = False) -> None:
    """Notes as text files, a folder for each category; names that are known already are left out.

    A file costs far more than its text, so notes are dealt evenly to more tasks than cores, however the input is split; where
    some are known, by their names, as the join needs them, so that texts are shuffled once. With
    ``folders`` each task's notes lie in a folder of their own below the category, which the commit moves whole; without, the
    driver moves them one by one. On disks ``note_files`` makes the files, on other file systems Spark's text files do.
    """
    notes, tasks = markdown_note(df.withColumn("category", F.col(category)), ["category"]), file_tasks(df)
    dealt = notes.repartition(tasks, *([] if known is None else ["file_name"])).withColumn("folder", F.spark_partition_id())
    if known is not None:
        dealt = dealt.join(known.select("file_name").repartition(tasks, "file_name"), "file_name", "left_anti")
    by = ["category", "folder"] if folders else ["category"]
    writer = dealt.select(*by, F.col("note").alias("value")).write.mode("append")
    if (disk := disk_path(df.sparkSession, path)) is None:
        writer.partitionBy(*by).option("maxRecordsPerFile", 1).text(path)
    else:
        df.sparkSession.dataSource.register(NoteFiles)
        writer.format("note_files").save(disk)


def file_tasks(df: DataFrame) -> int:
    """Tasks for work that is counted in files, not bytes."""
    return max(4 * df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def push_totals(results: DataFrame, by: str, error: str = "error") -> DataFrame:
    """Rows (by, total, errors)."""
    return results.groupBy(by).agg(F.count("*").alias("total"), F.count_if(F.col(error).isNotNull()).alias("errors"))

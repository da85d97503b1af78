"""File scans: JSON and text, by run, by name and by trailing days."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sieveline.session import found

#: Files that the driver lists at a time; each takes a kilobyte or more of its memory.
LISTED = 20_000


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines by schema; a path that does not exist is an empty table."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_run(spark: SparkSession, folder: str, run_id: str, schema: StructType | str) -> DataFrame:
    """What one run wrote: the partition ``run_id=...`` of a folder."""
    return read_json(spark, f"{folder}/run_id={run_id}", schema)


def read_named(spark: SparkSession, folders: list[str], name: str, schema: StructType | str) -> DataFrame:
    """All files of a name below several folders, with their path as ``_file``."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", name)
    return reader.json(folders).withColumn("_file", F.input_file_name())


def trailing_days(items: DataFrame, day: str, run_day: str, n: int = 30) -> DataFrame:
    """Rows of the ``n`` days up to and with the run's: on a partition column, partition pruning."""
    last = F.lit(run_day).cast("date")
    return items.where((F.col(day) > F.date_sub(last, n)) & (F.col(day) <= last))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as rows (path, text)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_notes(spark: SparkSession, path: str, notes: int, listed: int = LISTED) -> Iterator[DataFrame]:
    """Rows (category, value) of what ``write_notes`` wrote with ``folders``, some folders at a time: about ``listed`` files.

    Spark's driver holds the path of every file of a table, so use each DataFrame up before the next. ``notes``: how many there
    are at most. Files are read as bytes, since the text reader copies all of Hadoop's settings for each file.
    """
    schema = "path string, modificationTime timestamp, length long, content binary, category string, folder int"
    folders = sorted(found(spark, f"{path}/category=*/folder=*"), key=lambda f: (int(f.rpartition("=")[2]), f))  # each has notes of all categories
    some = max(1, listed * len(folders) // max(notes, 1))
    for k in range(0, len(folders), some):
        files = _loaded(spark.read.format("binaryFile").schema(schema).option("basePath", path), spark, folders[k : k + some])
        yield files.select("category", F.col("content").cast("string").alias("value"))
    if not folders:
        yield spark.createDataFrame([], "category string, value string")


def _loaded(reader: DataFrameReader, spark: SparkSession, paths: list[str]) -> DataFrame:
    """Load without keeping the list of files for later reads, which takes up to 250 MB of the driver."""
    key = "spark.sql.hive.filesourcePartitionFileCacheSize"
    before = spark.conf.get(key)
    spark.conf.set(key, 0)
    try:
        return reader.load(paths)
    finally:
        spark.conf.set(key, before)


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Post folders of base, update and truth texts as rows (post_id, kind, dup_type, text)."""
    name = F.regexp_extract("path", r"([^/]+)\.txt$", 1)
    rows = read_texts(spark, f"{path}/*/*.txt")
    return rows.select(
        F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("post_id"), F.regexp_extract(name, "^(base|update|ground_truth)", 1).alias("kind"),
        F.nullif(F.regexp_replace(name, "^(base|update_|ground_truth_)", ""), F.lit("")).alias("dup_type"), "text",
    )

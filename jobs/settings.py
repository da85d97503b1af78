"""Settings of the jobs: small JSON files, read through Spark so that they may lie wherever Spark reads."""

from __future__ import annotations

from dataclasses import fields
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

S = TypeVar("S")


def load(spark: SparkSession, path: str | None, kind: type[S]) -> S:
    """The settings of a JSON file over the defaults; names that ``kind`` does not have are an error."""
    if path is None:
        return kind()
    rows = spark.read.option("multiLine", True).json(path).collect()  # one object
    if len(rows) != 1:
        raise ValueError(f"{path} holds {len(rows)} objects, not one")
    given = {k: v for k, v in rows[0].asDict(recursive=True).items() if v is not None}
    unknown = set(given) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"{path} has unknown settings: {sorted(unknown)}")
    return kind(**given)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds the path, or anything that matches it."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True

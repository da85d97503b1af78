"""Session, table and shared-storage helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine is tested with; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sieveline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read lazily so that filters and columns reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that all its machines share")
        made = tempfile.mkdtemp(prefix="sieveline-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        found = f"file://{made}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: The tables that ``materialize`` writes within the innermost ``with Tables(spark)``, if there is one.
_SCOPE: ContextVar[Tables | None] = ContextVar("tables", default=None)


class Tables:
    """The tables that ``materialize`` writes within a ``with`` block, so that a job can delete its own and nobody else's."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Tables:
        self._outer = _SCOPE.set(self)
        return self

    def __exit__(self, *error: object) -> None:
        _SCOPE.reset(self._outer)

    def clear(self, keep: DataFrame | None = None) -> None:
        """Delete what was written so far, but what ``keep`` reads: for use once the results that depend on it lie elsewhere."""
        plain = lambda path: path.removeprefix("file://").removeprefix("file:")
        held = set() if keep is None else {plain(f.split("/part-")[0]) for f in keep.inputFiles()}
        for path in [p for p in self.paths if plain(p) not in held]:
            remove(self.spark, path)
            self.paths.remove(path)


def materialize(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage and survives lost executors; unlike ``checkpoint()`` it
    computes the plan once and stores columns, not rows. With ``compact`` a shuffled result is
    written by no more tasks than keep the cluster busy, for results that are small for their
    shuffle; it then has that many files instead of one for each shuffle partition.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    if (scope := _SCOPE.get()) is not None:
        scope.paths.append(path)
    (compacted(df) if compact else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compacted(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, on whatever file system it lies."""
    target, system = _located(spark, path)
    system.delete(target, True)


def disk_path(spark: SparkSession, path: str) -> str | None:
    """The path as programs open it if it lies on a local or mounted disk, else nothing."""
    target, system = _located(spark, path)
    return system.makeQualified(target).toUri().getPath() if system.getUri().getScheme() == "file" else None


def found(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a pattern, on whatever file system they lie: for folders, which are few, not for files."""
    target, system = _located(spark, pattern)
    return [s.getPath().toString() for s in system.globStatus(target) or []]


def _located(spark: SparkSession, path: str):
    """Hadoop's path and the file system it lies on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

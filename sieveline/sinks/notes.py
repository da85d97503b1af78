"""A sink of one text file a row for local and mounted disks, as a Python data source.

Hadoop starts a process (``chmod``) for each file that it makes on such a disk, and another for the file's checksums, which costs
far more than the file. Here tasks make the files themselves. Each attempt of a task writes to a hidden folder of its own; Spark
says at the end which ones succeeded, and these folders are moved into place.
"""

from __future__ import annotations

import os
import re
import shutil
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Spark's planning workers need not find this package

#: What Spark escapes in the names of partition folders.
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


class NoteFiles(DataSource):
    """``df.write.format("note_files").mode("append").save(path)``: column ``value`` as files, the columns before it as partition folders."""

    @classmethod
    def name(cls) -> str:
        return "note_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("notes are appended")
        return _Writer(self.options["path"], [c for c in schema.names if c != "value"])


@dataclass
class _Written(WriterCommitMessage):
    attempt: str
    folders: list[str]


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, by: list[str]):
        self.path, self.by, self.job = path, by, uuid.uuid4().hex
        self.staged = f"{path}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        attempt, folders, n = uuid.uuid4().hex, set(), 0
        name = f"part-{TaskContext.get().partitionId():05d}-{self.job}"
        for batch in iterator:
            keys = [[f"{c}={_escaped(v)}" for v in batch.column(c).to_pylist()] for c in self.by]
            for *key, value in zip(*keys, batch.column("value"), strict=True):
                folder = "/".join(key)
                if folder not in folders:
                    os.makedirs(f"{self.staged}/{attempt}/{folder}")
                    folders.add(folder)
                with open(f"{self.staged}/{attempt}/{folder}/{name}.c{n:03d}.txt", "wb") as f:
                    f.write((value.as_py() or "").encode() + b"\n")
                n += 1
        return _Written(attempt, sorted(folders))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            for folder in m.folders if m else []:
                _move(f"{self.staged}/{m.attempt}/{folder}", f"{self.path}/{folder}")
        self._clear()
        os.makedirs(self.path, exist_ok=True)
        open(f"{self.path}/_SUCCESS", "wb").close()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        shutil.rmtree(self.staged, ignore_errors=True)
        if os.path.isdir(above := os.path.dirname(self.staged)) and not os.listdir(above):
            os.rmdir(above)


def _escaped(value: object) -> str:
    return "__HIVE_DEFAULT_PARTITION__" if value in (None, "") else _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", str(value))


def _move(folder: str, to: str) -> None:
    """Move a folder as a whole, or its files where the other exists."""
    os.makedirs(os.path.dirname(to), exist_ok=True)
    if not os.path.exists(to):
        os.rename(folder, to)
        return
    for name in os.listdir(folder):
        os.rename(f"{folder}/{name}", f"{to}/{name}")

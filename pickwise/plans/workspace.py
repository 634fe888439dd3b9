"""Owner of intermediate tables: what a run writes to the shared folder goes when it closes.

A workspace is one folder below the session's shared checkpoint folder.  While it is
active (``with work.active():``), :func:`pickwise.plans.guards.materialize` writes its
tables there as Parquet instead of as checkpoints that nobody removes; lineage is cut
all the same, and a lost executor costs nothing, since the files lie in the shared
folder.  ``close()`` deletes the folder; as a context manager the workspace closes
itself, also after a failure.  Tables read from it must not be used after that.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from pickwise.session import shared_dir

_ACTIVE: ContextVar[Workspace | None] = ContextVar("pickwise_workspace", default=None)


def file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system and path of ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def stamp(spark: SparkSession, path: str) -> tuple:
    """(name, length, modification time) of the files below ``path``: changes when they do."""
    fs, where = file_system(spark, path)
    found, files = [], fs.listFiles(where, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


class Workspace:
    def __init__(self, spark: SparkSession, name: str = "work"):
        self.spark, self.root, self.made, self.closed = spark, shared_dir(spark, name), 0, False

    def folder(self, name: str) -> str:
        """A fresh folder name inside the workspace."""
        if self.closed:
            raise RuntimeError("the workspace is closed")
        self.made += 1
        return f"{self.root}/{self.made:04d}-{name}"

    def table(self, df: DataFrame) -> DataFrame:
        """``df`` written to the workspace and read back."""
        path = self.folder("table")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @contextmanager
    def active(self) -> Iterator[Workspace]:
        """Intermediate tables made inside the block belong to this workspace."""
        token = _ACTIVE.set(self)
        try:
            yield self
        finally:
            _ACTIVE.reset(token)

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            fs, where = file_system(self.spark, self.root)
            fs.delete(where, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def current() -> Workspace | None:
    """The workspace that is active in this thread of control, if any."""
    return _ACTIVE.get()

"""Intermediate tables in the shared folder of the cluster.

Iterative jobs cut their lineage by writing a table and reading it back, so a
lost executor costs at most the current step.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder set for the session.

    Only a local session without one gets a folder of its own: a machine-local
    folder on a cluster would not be seen by the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.sparkContext.getCheckpointDir()
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="bitacora-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def stage_at(df: DataFrame, path: str, mode: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` to a path and read it back; ``measures`` are taken on the way."""
    spark, seen = df.sparkSession, {}
    if measures:
        observation = Observation()
        df = df.observe(observation, *[m.alias(name) for name, m in measures.items()])
        df.write.mode(mode).parquet(path)
        seen = observation.get
    else:
        df.write.mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen


_made: ContextVar[list[Workspace] | None] = ContextVar("made", default=None)


@contextmanager
def temporary() -> Iterator[None]:
    """Workspaces made inside are removed in the end, whether it succeeds or fails."""
    made: list[Workspace] = []
    token = _made.set(made)
    try:
        yield
    finally:
        _made.reset(token)
        for ws in made:
            ws.remove()


class Workspace:
    """A folder of its own for the tables of one job."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{shared_folder(spark).rstrip('/')}/bitacora-{uuid.uuid4().hex}"
        self._tables = 0
        if (made := _made.get()) is not None:
            made.append(self)

    def stage(self, df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
        """Write ``df`` and read it back; ``measures`` are taken on the way."""
        self._tables += 1
        return stage_at(df, f"{self.path}/{self._tables:04d}", "error", **measures)

    def remove(self) -> None:
        """Delete the folder.  Frames that read its tables stop working."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        system.delete(folder, True)

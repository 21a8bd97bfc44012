"""Intermediate tables that cut lineage and survive the loss of executors.

Tables go under ``spark.checkpoint.dir``, the shared folder the cluster names.
Only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rollcall-"))
        return context.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/rollcall-{label}-{uuid.uuid4().hex}"


@dataclass
class Kept:
    """A written intermediate table. ``drop`` removes the folder this object wrote, nothing else."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        spark = self.df.sparkSession
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Tables of the run in progress. Each thread and task of a program has its own.
_run: ContextVar[list[Kept] | None] = ContextVar("rollcall_run", default=None)


def keep(df: DataFrame, label: str) -> Kept:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    kept = Kept(spark.read.schema(df.schema).parquet(path), path)
    own = _run.get()
    if own is not None:
        own.append(kept)
    return kept


@contextmanager
def scratch_dropped_after() -> Iterator[None]:
    """Removes the intermediate tables written inside the block when it ends, whatever its outcome."""
    own: list[Kept] = []
    token = _run.set(own)
    try:
        yield
    finally:
        _run.reset(token)
        for kept in own:
            kept.drop()

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.operators.graph import ensure_checkpoint_dir

__all__ = ["Room", "batches_of", "ensure_checkpoint_dir", "kept", "scratch", "stored", "table", "text_or_empty", "tidy"]


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own in the cluster's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sievework-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes df to the shared folder and reads it back: later stages survive lost executors and recompute nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is run inside, so that wide rows do not add up in a task's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """What a Python worker makes once for its later tasks, until ``tidy`` of a task that has no use for it."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def tidy(keep: str | None = None) -> None:
    """Lets go what is ``kept`` under other names and gives freed memory back to the system; Python workers outlive tasks."""
    import ctypes

    import pyarrow as pa

    for name in [n for n in _KEPT if n != keep]:
        del _KEPT[name]
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Room:
    """Scratch tables of one call. ``close`` deletes them, once the call's result is stored elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        self.paths.append(scratch(self.spark, name))
        return self.paths[-1]

    def stored(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = self.path(name)
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            at = hadoop(path)
            at.getFileSystem(conf).delete(at, True)
        self.paths = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))

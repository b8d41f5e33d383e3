"""Structured Streaming jobs over folders of arriving files: processing time, idempotent batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 4) -> DataFrame:
    """Rows of Parquet files as they arrive; a few files a batch bound the work in flight."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Handles everything that has arrived, batch by batch, and stops."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
    q.awaitTermination()


def commit_once(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that is written to once a batch: a batch that runs again replaces its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def pipeline(stream: DataFrame, path: str, checkpoint: str, process: Callable[[DataFrame], DataFrame]) -> None:
    """Fetch, process, write: each batch goes through ``process`` and is committed once."""
    sink = commit_once(path)
    run_available(stream, checkpoint, lambda b, n: sink(process(b), n))


def running_totals(stream: DataFrame, path: str, checkpoint: str, keys: list[str], value: str) -> None:
    """Cumulative counters; every batch replaces the table of totals."""
    totals = stream.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    run_available(totals, checkpoint, lambda b, n: b.write.mode("overwrite").parquet(path), "complete")


def interval_counts(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> None:
    """Counts of each batch alone: what came since the last report."""
    sink = commit_once(path)
    run_available(stream, checkpoint, lambda b, n: sink(b.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("batch", F.lit(n)), n))


def follow_missing(stream: DataFrame, derived: str, checkpoint: str, key: str, derive: Callable[[DataFrame], DataFrame]) -> None:
    """Derives only rows whose key the derived table does not have yet. The table's folder must be there."""
    spark = stream.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        have = spark.read.parquet(derived).select(key)
        fresh = batch.dropDuplicates([key]).join(have, key, "left_anti")
        derive(fresh).write.mode("append").parquet(derived)

    run_available(stream, checkpoint, each)


def retry_pass(state: DataFrame, outcome: DataFrame, key: str, retries: int) -> DataFrame:
    """State after a pass: a failed row's attempts grow; with ``retries`` of them it is given up."""
    s = state.join(outcome.select(key, "ok"), key, "left")
    failed = ~F.coalesce("ok", F.lit(True))
    tries = F.col("attempts") + failed.cast("int")
    done = F.when(F.col("ok"), "done").when(failed & (tries >= retries), "given up").when(failed, "failed").otherwise(F.col("state"))
    return s.select(key, done.alias("state"), tries.alias("attempts"))


def with_priority(first: DataFrame, then: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows of two sources up to a common limit, all of the first before any of the second."""
    both = first.withColumn("_p", F.lit(0)).unionByName(then.join(first.select(key), key, "left_anti").withColumn("_p", F.lit(1)))
    return both.orderBy("_p", key).limit(limit).drop("_p")


def new_since(posts: DataFrame, known_to: int, reached_end: bool, oldest: int, overlap: int = 5) -> DataFrame:
    """Posts newer than a high-water mark, with a small overlap, and, unless the end was reached, those older than the oldest known.
    The mark is no event-time watermark: it bounds what is fetched, it does not drop late rows."""
    newer = F.col("post_id") > known_to - overlap
    return posts.where(newer if reached_end else newer | (F.col("post_id") < oldest))

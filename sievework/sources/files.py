"""Sources and sinks: Arrow streams, folders of files, exports, manifests, caches and bundles."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievework.operators.search import FILE_ROWS

#: The first bytes of common image formats.
IMAGE_MAGIC = (("89504E470D0A1A0A", "png"), ("FFD8FF", "jpg"), ("47494638", "gif"), ("424D", "bmp"))


def read_arrow_streams(spark: SparkSession, paths: str, schema: str) -> DataFrame:
    """Rows of Arrow IPC stream files, read by tasks through Spark's own file access. One file is one task's work."""
    raw = spark.read.format("binaryFile").load(paths).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for blob in rb.column(0):
                with pa.ipc.open_stream(pa.py_buffer(blob.as_py())) as reader:
                    yield from reader

    return raw.mapInArrow(run, schema)


def to_parquet_verified(df: DataFrame, path: str, row_group_rows: int = 131_072) -> int:
    """Writes zstd Parquet and checks the number of rows read back against the number written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", row_group_rows).parquet(path)
    written, there = seen.get["rows"], df.sparkSession.read.parquet(path).count()
    if written != there:
        raise RuntimeError(f"{path}: wrote {written} rows, {there} are there")
    return there


def scan_folder(spark: SparkSession, root: str, glob: str = "*", content: bool = False) -> DataFrame:
    """Files below a folder: ``path, dir, stem, ext, size, modified`` (and ``content``). Names in lower case; ``stem`` groups sidecars."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    out = f.select("path", F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"), F.lower(F.regexp_replace(name, r"\.[^.]*$", "")).alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("ext"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), *(["content"] if content else []))
    return out


def sidecar_groups(files: DataFrame, images: Sequence[str] = ("jpg", "jpeg", "png", "webp")) -> DataFrame:
    """One row for each folder and stem with an image: its path and its other files."""
    is_image = F.col("ext").isin(*images)
    g = files.groupBy("dir", "stem").agg(F.min(F.when(is_image, F.col("path"))).alias("image"), F.array_sort(F.collect_list(F.when(~is_image, F.col("path")))).alias("sidecars"))
    return g.where(F.col("image").isNotNull())


def content_type(content: Column) -> Column:
    """A file type by the first bytes; null if unknown."""
    head = F.hex(F.substring(content, 1, 12))
    out = F.when(F.startswith(head, F.lit("52494646")) & (F.substring(head, 17, 8) == "57454250"), "webp")
    for magic, name in IMAGE_MAGIC:
        out = out.when(F.startswith(head, F.lit(magic)), name)
    return out


def flatten_records(df: DataFrame, column: str, schema: str, paths: dict[str, str]) -> DataFrame:
    """Nested JSON records as flat columns; a record that cannot be read gives nulls."""
    rec = df.withColumn("_rec", F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"}))
    return rec.select(*[F.col(f"_rec.{p}").alias(n) for n, p in paths.items()])


def export(df: DataFrame, path: str, kind: str) -> None:
    """Writes JSON Lines or Parquet."""
    writer = df.write.mode("overwrite")
    {"jsonl": writer.json, "parquet": writer.parquet}[kind](path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a messenger's JSON export: one for each message; text parts joined."""
    m = spark.read.option("multiLine", True).json(path).select(F.explode("messages").alias("m")).select("m.*")
    return m


def fresh(cache: DataFrame, now: float, ttl: float) -> DataFrame:
    """Cached responses no older than ``ttl`` seconds."""
    return cache.where(F.lit(now) - F.col("ts") <= ttl)


def cache_key(method: Column, params: Column) -> Column:
    """A key for a call: method and parameters in the order of their names."""
    pairs = F.array_sort(F.transform(F.map_entries(params), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return F.sha1(F.concat_ws("&", method, F.array_join(pairs, "&")))


def write_manifest(df: DataFrame, path: str) -> None:
    """Writes CSV with a header in each of its files, which are small enough for a task each."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("maxRecordsPerFile", FILE_ROWS).csv(path)


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(path)


def bundle(tables: dict[str, DataFrame], selected: DataFrame, key: str, path: str, drop: Sequence[str] = ()) -> None:
    """The rows of each table whose key is selected, without local columns, one Parquet folder a table."""
    for name, t in tables.items():
        t.join(selected.select(key).distinct(), key, "left_semi").drop(*drop).write.mode("overwrite").parquet(f"{path}/{name}")


class _Page(InputPartition):
    def __init__(self, path: str):
        self.path = path


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.pages = json.loads(options["pages"])

    def partitions(self):
        return [_Page(p) for p in self.pages]

    def read(self, partition):
        for i, item in enumerate(json.loads(partition.path)["items"]):
            yield (int(item["id"]), item.get("title"), i)


class PagedSource(DataSource):
    """A paged listing as a source, one partition a page. Pages come as JSON texts in the option ``pages``; a client of a service would
    fetch them in ``read``."""

    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return "id bigint, title string, position int"

    def reader(self, schema):
        return PagedReader(self.options)


def first_seen(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of a search over queries and pages, each key once, where it came first."""
    rest = [c for c in rows.columns if c not in (key, *order)]
    return rows.groupBy(key).agg(F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_r")).select(key, "_r.*")



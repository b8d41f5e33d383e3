"""Sharding by Hilbert-curve order.

Several metadata dimensions are quantised to a grid, rows are sorted by the grid cell's index on a Hilbert curve, and the sorted
run is cut into shards, so that each shard covers a compact region of every dimension and its minima and maxima prune scans.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sievework.llm.common import stored, table, text_or_empty

BITS = 6
SHARDS = 24


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points ``cells`` (rows, dims), each coordinate below ``2**bits``.

    Gray-code transposition: from the highest bit down, undo the reflections and exchanges of the sub-cube, then Gray-decode and
    interleave the bits. Vectorised over rows.
    """
    x = np.array(cells, dtype=np.uint64).T.copy()
    dims = x.shape[0]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        p = q - one
        for d in range(dims):
            flip = (x[d] & q) != 0
            t = (x[0] ^ x[d]) & p
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ t)
            if d:
                x[d] = np.where(flip, x[d], x[d] ^ t)
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    t = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - one), t)
    x ^= t
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = (out << one) | ((x[d] >> np.uint64(level)) & one)
    return out.astype(np.int64)


#: Bytes of a category that place it on its axis, after what all its values begin with.
CODE_BYTES = 6


def _code(col: Column, skip: int) -> Column:
    """A number in the order of the category's values: its ``CODE_BYTES`` bytes after the first ``skip``. Null comes before all."""
    part = F.hex(F.substring(col.cast("string").cast("binary"), skip + 1, CODE_BYTES))
    return F.when(col.isNull(), F.lit(-1.0)).otherwise(F.conv(F.rpad(part, 2 * CODE_BYTES, "0"), 16, 10).cast("double"))


def _shared_start(low: str | None, high: str | None) -> int:
    """How many bytes all values between two begin with."""
    a, b = (low or "").encode(), (high or "").encode()
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def hilbert_index_column(df: DataFrame, categories: Sequence[str], numbers: Sequence[str], bits: int = BITS, out: str = "hilbert") -> DataFrame:
    """Adds the curve index of each row.

    Categories stand on their axis in the order of their values, by what follows the bytes that all values share, so a run of the curve
    covers a range of them. All axes are cut at approximate quantiles (two small aggregates; nulls go to cell 0).
    """
    cells = 1 << bits
    at = [i / cells for i in range(1, cells)]
    skips = []
    if categories:
        row = df.agg(*[f(F.col(c).cast("string")).alias(f"{n}{i}") for i, c in enumerate(categories) for n, f in (("a", F.min), ("b", F.max))]).first()
        skips = [_shared_start(row[f"a{i}"], row[f"b{i}"]) for i in range(len(categories))]
    axes = [*[_code(F.col(c), k) for c, k in zip(categories, skips, strict=True)], *[F.col(c).cast("double") for c in numbers]]
    row = df.agg(*[F.percentile_approx(x, at, 20_000).alias(f"e{i}") for i, x in enumerate(axes)]).first()
    edges = [np.asarray(list(v or []), dtype=np.float64) for v in row]

    @F.pandas_udf(T.LongType())
    def index(axis: pd.DataFrame) -> pd.Series:
        cols = []
        for i, e in enumerate(edges):
            v = axis.iloc[:, i].to_numpy(dtype=np.float64)
            cols.append(np.where(np.isnan(v), 0, np.searchsorted(e, v, side="right")))
        return pd.Series(hilbert_index(np.stack(cols, axis=1), bits))

    return df.withColumn(out, index(F.struct(*[x.alias(f"x{i}") for i, x in enumerate(axes)])))


def in_order(keyed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stores the rows in the order of ``keys`` with ``_mid``, a growing row number with gaps."""
    return stored(keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id()), "hilbert")


def cut_runs(ordered: DataFrame, shards: int, law: str, size: str) -> DataFrame:
    """Cuts the stored curve order into ``shards`` runs: ``shard`` and ``slot`` (gapless from 0 within the shard).

    ``rows``: row counts differ by one at most. ``bytes``: a row goes where the middle of its bytes falls among equal cuts of the
    total. Only one row per sorted partition reaches the driver.
    """
    spark = ordered.sparkSession
    part = F.shiftright(F.col("_mid"), 33)
    tail = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted(tuple(r) for r in ordered.groupBy(part.alias("p")).agg(F.count("*"), F.sum(F.col(size))).collect())
    before, rows, total = [], 0, 0
    for p, n, b in counts:
        before.append((p, rows, total))
        rows, total = rows + n, total + int(b or 0)
    offsets = spark.createDataFrame(before, "_p long, _rows long, _bytes long")
    placed = ordered.withColumn("_p", part).join(F.broadcast(offsets), "_p").withColumn("_rank", F.col("_rows") + tail)
    if law == "rows":
        placed = placed.withColumn("shard", F.expr(f"cast((_rank * {shards}L) div {max(rows, 1)}L as int)"))
        start = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
        placed = placed.withColumn("slot", F.col("_rank") - start)
    elif law == "bytes":
        run = Window.partitionBy("_p").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
        placed = placed.withColumn("_end", F.col("_bytes") + F.sum(size).over(run))
        placed = placed.withColumn("shard", F.expr(f"cast(least({shards - 1}, ((2 * _end - {size}) * {shards}L) div {max(2 * total, 1)}L) as int)"))
        first = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))
        placed = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("_rank") - F.col("_first"))
    else:
        raise ValueError(f"unknown law {law!r}")
    return placed.drop("_p", "_rows", "_bytes", "_rank", "_mid", "_end", "_first")


def extents(sharded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of each column by shard: what a reader prunes by."""
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def shard_documents(docs: DataFrame, shards: int = SHARDS, law: str = "rows", bits: int = BITS, id_col: str = "doc_id", text_col: str = "text", categories: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Shards documents by language, source and size along a Hilbert curve.

    Returns id, ``size`` (UTF-8 bytes of the text, none if null, plus 8), ``text_crc32``, the categories, ``hilbert``, ``law``,
    ``shard`` and ``slot``. Equal texts stand together, at the smallest index among them, so only a border between two shards parts
    them. Texts are read once; only these small columns are sorted. Null categories are values of their own, before all others, and
    null ids values like any other; an empty table gives no rows; other columns are ignored.
    """
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_same"), *[F.col(c).alias(f"cat_{c}") for c in categories])
    keyed = hilbert_index_column(stored(base, "shard-base"), [f"cat_{c}" for c in categories], ["size"], bits)
    keyed = stored(keyed, "shard-keyed")
    group = ["size", "text_crc32", "_same"]
    place = keyed.groupBy(*group).agg(F.min("hilbert").alias("_place"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    keyed = keyed.join(place, group, "left").withColumn("_place", F.coalesce("_place", "hilbert"))
    ordered = in_order(keyed, ["_place", *group, "id"])
    return cut_runs(ordered, shards, law, "size").drop("_place", "_same").withColumn("law", F.lit(law)).withColumnRenamed("id", id_col)


def op2_hilbert_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards under the law ``rows``, each with its shard's ranges (24 rows, so they are broadcast)."""
    out = stored(shard_documents(table(spark, sf_dir, "documents")), "shards")
    ranges = extents(out, ["size", "cat_lang", "cat_source"])
    own = ["doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"]
    return out.join(F.broadcast(ranges), "shard").select(*own, "min_size", "max_size", *[f"{n}_cat_{c}" for c in ("lang", "source") for n in ("min", "max")])

"""Keyed-table operations: upserts, staleness, latest state, logs and undo. Each returns a new frame; nothing is changed in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators.graph import ensure_checkpoint_dir


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], update: Sequence[str], once: Sequence[str] = ()) -> DataFrame:
    """Full outer merge by key: ``update`` columns take the new value where the key is in ``new``; others, and ``once`` columns such as a
    first-seen time, keep the old row's. Keys unique on both sides."""
    rest = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*rest).alias("_o"))
    n = new.select(*keys, F.struct(*[c for c in rest if c in new.columns]).alias("_n"))
    both = o.join(n, list(keys), "full")

    def value(c: str) -> Column:
        mine, theirs = F.col(f"_o.{c}"), F.col(f"_n.{c}") if c in new.columns else F.lit(None)
        if c in update and c not in once:
            return F.when(F.col("_n").isNotNull(), theirs).otherwise(mine)
        return F.when(F.col("_o").isNotNull(), mine).otherwise(theirs)

    return both.select(*keys, *[value(c).alias(c) for c in rest])


def merge_prefer_new(old: DataFrame, new: DataFrame, keys: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """Full outer merge where a new value wins unless it is null; list columns are united, old entries first."""
    rest = [c for c in old.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in rest])
    empty = {c: F.array().cast(old.schema[c].dataType) for c in lists}
    value = lambda c: F.array_union(F.coalesce(F.col(c), empty[c]), F.coalesce(F.col(f"_n_{c}"), empty[c])) if c in lists else F.coalesce(F.col(f"_n_{c}"), F.col(c))
    return old.join(n, list(keys), "full").select(*keys, *[value(c).alias(c) for c in rest])


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The old rows and those new ones whose key is not there yet."""
    return old.unionByName(new.join(old.select(*keys), list(keys), "left_anti").select(*old.columns))


def insert_replace(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    return new.select(*old.columns).unionByName(old.join(new.select(*keys), list(keys), "left_anti").select(*old.columns))


def pending(work: DataFrame, derived: DataFrame, keys: Sequence[str], version: int, redo: bool = False) -> DataFrame:
    """Rows whose derived row is missing or made by another version of the recipe; with ``redo`` all."""
    return work if redo else work.join(derived.where(F.col("version") == version).select(*keys), list(keys), "left_anti")


def latest(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The newest row of each key: an aggregate, so no sort and a combine before the shuffle."""
    rest = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def undo_to(log: DataFrame, keys: Sequence[str], order: str, before: str) -> DataFrame:
    """What a reverse replay of the log restores: each key's value from before its first change."""
    return log.groupBy(*keys).agg(F.min_by(before, order).alias(before))


def add_counters(counters: DataFrame, deltas: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return counters.select(*keys, value).unionByName(deltas.select(*keys, value)).groupBy(*keys).agg(F.sum(value).alias(value))


def numbered(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rows with their number in an order over the whole table, from 1, without a task that holds them all.

    Rows are sorted in ranges and kept by a reliable checkpoint, so that their places stay; one count a range reaches the driver.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_mid", 33)
    before, total = [], 0
    for p, n in sorted(tuple(r) for r in rows.groupBy(part.alias("p")).count().collect()):
        before.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(before, "_part long, _before long")
    placed = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, F.col("_before") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_before", "_mid")


def assign_ids(existing: DataFrame, names: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Names not yet there with dense new ids after the largest one, in the order of the names. One small job finds the largest id."""
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).first()["m"]
    fresh = names.select(name_col).distinct().join(existing.select(name_col), name_col, "left_anti")
    return numbered(fresh, [F.col(name_col)], "_n").select((F.col("_n") + top).cast("long").alias(id_col), name_col)


def compare_sets(left: DataFrame, right: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, Column]], default: str = "kept") -> DataFrame:
    """Full outer join of two keyed tables and the first rule that holds; ``_l`` and ``_r`` tell which sides have the key."""
    j = left.withColumn("_l", F.lit(True)).join(right.withColumn("_r", F.lit(True)), list(keys), "full")
    j = j.withColumn("_l", F.coalesce("_l", F.lit(False))).withColumn("_r", F.coalesce("_r", F.lit(False)))
    out = None
    for name, cond in rules:
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return j.withColumn("status", out.otherwise(default))

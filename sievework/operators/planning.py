"""Planning jobs: each turns facts about rows into a plan table with one decision a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_rule(rules: Sequence[tuple[str, Column]], default: str) -> Column:
    """The name of the first rule that holds; null counts as false."""
    out = None
    for name, cond in rules:
        c = F.coalesce(cond, F.lit(False))
        out = F.when(c, name) if out is None else out.when(c, name)
    return out.otherwise(default)


def reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """Names of all rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, n) for n, c in rules]))


def latest_done(log: DataFrame, item: str, seq: str, run: str, kind: str) -> DataFrame:
    """The newest ``done`` row of each item that no later undo of its run, or of the item in that run, takes back.

    ``kind`` is ``done``, ``undo`` (of an item) or ``undo_run``. Two small aggregates of the undos join the log; no replay.
    """
    done = log.where(F.col(kind) == "done")
    of_run = log.where(F.col(kind) == "undo_run").groupBy(run).agg(F.max(seq).alias("_run_undo"))
    of_item = log.where(F.col(kind) == "undo").groupBy(run, item).agg(F.max(seq).alias("_item_undo"))
    alive = done.join(of_run, run, "left").join(of_item, [run, item], "left")
    alive = alive.where((F.coalesce("_run_undo", F.lit(-1)) < F.col(seq)) & (F.coalesce("_item_undo", F.lit(-1)) < F.col(seq))).drop("_run_undo", "_item_undo")
    rest = [c for c in log.columns if c != item]
    return alive.groupBy(item).agg(F.max_by(F.struct(*rest), seq).alias("_r")).select(item, "_r.*")


def cached(work: DataFrame, cache: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows with cached values where the whole key matches, and ``hit``."""
    c = cache.select(*keys, *values, F.lit(True).alias("hit"))
    return work.join(c, list(keys), "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def work_list(saved: DataFrame, done: DataFrame, attempts: DataFrame, key: str, retries: int, redo: bool = False) -> DataFrame:
    """Rows still to do: not done unless ``redo``, and tried fewer than ``retries`` times."""
    todo = saved if redo else saved.join(done.select(key), key, "left_anti")
    return todo.join(attempts.select(key, "attempts"), key, "left").where(F.coalesce("attempts", F.lit(0)) < retries).drop("attempts")


def numbered_folders(df: DataFrame, category: str, order: Sequence[str], most: int) -> DataFrame:
    """``folder``: each category's rows in order, at most ``most`` to a folder, numbered from 1."""
    rn = F.row_number().over(Window.partitionBy(category).orderBy(*order))
    return df.withColumn("folder", F.ceil(rn / most).cast("int"))


def choose_priority(probabilities: Column, margin: float) -> Column:
    """Of the classes within ``margin`` of the best, the first; positions from 0."""
    top = F.array_max(probabilities)
    near = F.filter(F.transform(probabilities, lambda p, i: F.struct((p >= top - margin).alias("ok"), i.alias("i"))), lambda s: s["ok"])
    return F.array_min(F.transform(near, lambda s: s["i"]))

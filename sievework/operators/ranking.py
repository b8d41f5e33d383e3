"""Ranking inside groups, keepers of groups, tiers, slots and names."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.operators.tables import numbered


def rank_in(df: DataFrame, groups: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("long"))


def cut_top(df: DataFrame, groups: Sequence[str], score: str, ident: str, floor: float | None = None, percent: float | None = None, tiers: str | None = None) -> DataFrame:
    """Best rows of each group by score (by tier first, if given): those at or above a floor, and of them at most a percentage of the
    group's size before the floor. Rows without a score take no part."""
    w = Window.partitionBy(*groups)
    scored = df.where(F.col(score).isNotNull())
    if percent is not None:
        scored = scored.withColumn("_n", F.count("*").over(w))
    if floor is not None:
        scored = scored.where(F.col(score) >= floor)
    order = [*([F.col(tiers).asc()] if tiers else []), F.col(score).desc(), F.col(ident).asc()]
    scored = rank_in(scored, groups, order)
    if percent is not None:
        scored = scored.where(F.col("rank") <= F.floor(F.col("_n") * percent / 100)).drop("_n")
    return scored


def top_of_each(df: DataFrame, group: str, order: Column, k: int, ident: str) -> DataFrame:
    """The first ``k`` rows of each group; Spark turns the bounded row number into a partial limit before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(order, F.col(ident)))).where(F.col("rank") <= k)


def seeded_order(seed: str, ident: str) -> Column:
    """A pseudo-random order that depends on the seed and the row alone."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(ident).cast("string")), 256)


def best_copy(members: pd.DataFrame, lead: float = 3.0, tie: float = 0.1) -> int:
    """Row position of a group's best copy.

    The highest tier is first choice; a lower tier takes over when its best score is at least ``lead`` above the holder's, and again from
    there. Within the winning tier, scores less than ``tie`` below the best count as equal and role, caption, age and path decide. No
    total order has this property, so each group is walked. Columns: tier, score, role, captioned, age, path.
    """
    rows = members.reset_index(drop=True)
    best = rows.groupby("tier")["score"].max().sort_index(ascending=False)
    tier = best.index[0]
    for t in best.index[1:]:
        if best[t] >= best[tier] + lead:
            tier = t
    near = rows[(rows["tier"] == tier) & (rows["score"] >= best[tier] - tie + 1e-12)]
    return int(near.sort_values(["role", "captioned", "age", "path"], ascending=[True, False, True, True]).index[0])


def choose_best_copies(df: DataFrame, group: str, lead: float = 3.0, tie: float = 0.1) -> DataFrame:
    """``group, path`` of each group's best copy. A tier keeps only rows that can win it (within ``tie`` of its best), so a large group
    reaches its task as the few candidates of each tier."""
    w = Window.partitionBy(group, "tier")
    able = df.withColumn("_best", F.max("score").over(w)).where(F.col("score") >= F.col("_best") - tie).drop("_best")
    first = Window.partitionBy(group, "tier").orderBy("role", F.col("captioned").desc(), "age", "path")
    best = able.withColumn("_top", F.max("score").over(w)).withColumn("_r", F.row_number().over(first)).where(F.col("_r") == 1)
    heads = best.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("tier", F.col("_top").alias("score"), "path")), asc=False).alias("h"))

    def take(acc, h):
        return F.when(acc.isNull() | (h["score"] >= acc["score"] + lead), h).otherwise(acc)

    none = F.lit(None).cast(heads.schema["h"].dataType.elementType)
    return heads.select(group, F.aggregate("h", none, take)["path"].alias("path"))


def step_aside(df: DataFrame, group: str, flag: str) -> DataFrame:
    """Flagged rows leave a group that has others."""
    return df.withColumn("_clean", F.max((~F.col(flag)).cast("int")).over(Window.partitionBy(group))).where((F.col("_clean") == 0) | ~F.col(flag)).drop("_clean")


def gap_tiers(df: DataFrame, score: str, ident: str, tiers: int, window: float = 0.25) -> DataFrame:
    """Quality tiers by rank, each border moved to the largest score gap near its ideal place.

    Borders depend on those before them, so they are found one by one, ``tiers - 1`` small queries over the ranked gaps. A border stays
    within ``window`` of a tier's size from the ideal place and after the border before it; of equal gaps the one nearest to the ideal.
    """
    ranked = numbered(df, [F.col(score).desc(), F.col(ident)], "_pos")
    after = ranked.select((F.col("_pos") - 1).alias("_pos"), F.col(score).alias("_after"))
    ranked = ranked.join(after, "_pos", "left").withColumn("_gap", F.col(score) - F.col("_after")).drop("_after").checkpoint()
    n = ranked.count()
    borders, before = [], 0
    for i in range(1, tiers):
        ideal, reach = n * i / tiers, max(1, int(n / tiers * window))
        near = ranked.where(F.col("_pos").between(max(before + 1, int(ideal) - reach), min(n - 1, int(ideal) + reach)))
        found = near.agg(F.max_by("_pos", F.struct("_gap", -F.abs(F.col("_pos") - F.lit(ideal)))).alias("p")).first()["p"]
        if found is not None:
            borders.append(found)
            before = found
    tier = F.lit(len(borders) + 1)
    for k, b in reversed(list(enumerate(borders))):
        tier = F.when(F.col("_pos") <= b, k + 1).otherwise(tier)
    return ranked.withColumn("tier", tier).drop("_pos", "_gap")


def sessions(df: DataFrame, groups: Sequence[str], order: Sequence[str], together: Column, name: str = "session") -> DataFrame:
    """Consecutive rows for which ``together`` holds (it may use ``_prev``, the row before) share a number that grows from 1."""
    w = Window.partitionBy(*groups).orderBy(*order)
    df = df.withColumn("_prev", F.lag(F.struct(*[F.col(c) for c in df.columns])).over(w))
    df = df.withColumn("_new", F.when(F.coalesce(together, F.lit(False)), 0).otherwise(1))
    return df.withColumn(name, F.sum("_new").over(w)).drop("_prev", "_new")


def slot_picks(df: DataFrame, groups: Sequence[str], order: Sequence[str], slots: int) -> DataFrame:
    """``slots`` contiguous slots over each ordered group; ``slot`` and ``try_order``, from a slot's centre outwards."""
    w = Window.partitionBy(*groups)
    d = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    k = F.least(F.lit(slots), F.col("_n"))
    d = d.withColumn("_k", k).withColumn("slot", F.expr("cast(((_i + 1) * _k - 1) div _n as int)"))
    lo, hi = F.expr("(slot * _n) div _k"), F.expr("((slot + 1) * _n) div _k")
    d = d.withColumn("_off", F.abs(F.col("_i") - F.floor((lo + hi - 1) / 2)))
    return d.withColumn("try_order", F.row_number().over(Window.partitionBy(*groups, "slot").orderBy("_off", "_i"))).drop("_i", "_n", "_k", "_off")


def collision_names(df: DataFrame, folder: str, stem: str, ident: str, name: str = "name") -> DataFrame:
    """The n-th row with one folder and stem (case ignored) gets ``-n`` after its stem."""
    n = F.row_number().over(Window.partitionBy(folder, F.lower(stem)).orderBy(ident))
    return df.withColumn(name, F.when(n == 1, F.col(stem)).otherwise(F.concat_ws("-", F.col(stem), n.cast("string"))))

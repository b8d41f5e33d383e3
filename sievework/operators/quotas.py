"""Quotas, apportionment and balance."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def largest_remainder(counts: DataFrame, key: str, count: str, total: int, by: Sequence[str] = ()) -> DataFrame:
    """Shares of ``total`` in proportion to ``count`` (within ``by``), summing to it exactly and never above the count.

    Whole parts first, then one more to the largest remainders; equal remainders by the key's text. A total above what there is gives
    everything.
    """
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    c = counts.withColumn("_all", F.sum(count).over(w)).withColumn("_t", F.least(F.lit(total).cast("long"), F.col("_all")))
    c = c.withColumn("_base", F.expr(f"(_t * `{count}`) div _all")).withColumn("_rem", F.expr(f"(_t * `{count}`) % _all"))
    c = c.withColumn("_left", F.col("_t") - F.sum("_base").over(w)).withColumn("_r", F.row_number().over(w.orderBy(F.col("_rem").desc(), F.col(key).cast("string"))))
    return c.withColumn("quota", F.least(F.col("_base") + (F.col("_r") <= F.col("_left")).cast("long"), F.col(count))).drop("_all", "_t", "_base", "_rem", "_left", "_r")


def balanced_pair(colour: Column, mono: Column, percent: int, total: int | None = None) -> tuple[Column, Column]:
    """How many of two pools to take for ``percent`` of the first, as many as both allow and at most ``total``."""
    share = percent / 100
    by_colour = F.when(F.lit(share) > 0, F.floor(colour / share)).otherwise(F.lit(1 << 60))
    by_mono = F.when(F.lit(share) < 1, F.floor(mono / (1 - share))).otherwise(F.lit(1 << 60))
    n = F.least(by_colour, by_mono, F.lit(total if total is not None else 1 << 60))
    c = F.least(colour, F.floor(n * share + 0.5 + 1e-9))
    return c.cast("long"), F.least(mono, n - c).cast("long")


def stratified_target(df: DataFrame, mode: str, stratum: str, area: str, ident: str, target: int, first_mode: str, first_share: float) -> DataFrame:
    """``target`` rows: a share of one mode, shortage filled from the other, spread over strata by largest remainder, largest areas first.

    One small aggregate of the two modes' sizes reaches the driver. No stratum's quota is above its mode's, so each task keeps that many
    rows of a stratum before they meet.
    """
    sizes = {r[0]: r[1] for r in df.groupBy((F.col(mode) == first_mode).alias("m")).count().collect()}
    want = min(sizes.get(True, 0), round(target * first_share))
    rest = min(sizes.get(False, 0), target - want)
    want = min(sizes.get(True, 0), target - rest)
    parts = []
    for is_first, n in ((True, want), (False, rest)):
        pool = df.where((F.col(mode) == first_mode) == is_first)
        quota = largest_remainder(pool.groupBy(stratum).agg(F.count("*").alias("_n")), stratum, "_n", n).select(stratum, "quota")
        w = Window.partitionBy(stratum).orderBy(F.col(area).desc(), F.col(ident))
        parts.append(pool.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).join(F.broadcast(quota), stratum).where(F.col("_r") <= F.col("quota")).drop("_r", "quota"))
    return parts[0].unionByName(parts[1])


def half_up(x: Column) -> Column:
    return F.floor(x + 0.5 + 1e-9)


def style_for(key: Column, shares: dict[str, int]) -> Column:
    """A style for each key: the first 8 bytes of its SHA-256 as a fraction, placed on the cumulative shares. Exact decimal borders."""
    top = F.conv(F.substring(F.sha2(key.cast("string").cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    total, run, out = sum(shares.values()), 0, None
    for name, n in shares.items():
        run += n
        border = F.lit(Decimal((run * (1 << 64)) // total)).cast("decimal(20,0)") if run < total else None
        cond = top < border if border is not None else F.lit(True)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def call_cost(count: Column, page: int = 100) -> tuple[Column, Column]:
    """Calls that a listing takes, one more for itself; an unknown count gives the least and a flag."""
    return F.lit(1) + F.greatest(F.lit(1), F.ceil(F.coalesce(count, F.lit(0)) / page)), count.isNull()


def merge_small_buckets(buckets: pd.DataFrame, least: int = 8, most_crop: float = 0.4, rounds: int = 10) -> pd.DataFrame:
    """Dissolves buckets of fewer than ``least`` rows into the nearest healthy one.

    Nearest by the logarithm of the aspect ratio, the same tier first, the same orientation, and no more than ``most_crop`` of the area
    cut off. When no small bucket finds a healthy one, the largest small one takes in others. Columns: tier, width, height, n; adds
    ``to`` (position of the bucket that a row ends in, itself if it stays). Sequential by nature; a pool has few buckets.
    """
    import math

    b = buckets.reset_index(drop=True)
    n, to = b["n"].astype(int).tolist(), list(range(len(b)))
    ratio = [math.log(w / h) for w, h in zip(b["width"], b["height"], strict=True)]

    def able(i, j):
        same_way = ratio[i] * ratio[j] >= 0
        crop = 1 - math.exp(-abs(ratio[i] - ratio[j]))
        return i != j and n[j] > 0 and same_way and crop <= most_crop

    def move(i, j):
        n[j] += n[i]
        n[i] = 0
        for k, t in enumerate(to):
            if t == i:
                to[k] = j

    for _ in range(rounds):
        changed = False
        for i in sorted((k for k in range(len(b)) if 0 < n[k] < least), key=lambda k: (n[k], k)):
            if not 0 < n[i] < least:
                continue
            near = sorted((j for j in range(len(b)) if n[j] >= least and able(i, j)), key=lambda j: (b["tier"][j] != b["tier"][i], abs(ratio[i] - ratio[j]), -n[j], j))
            if near:
                move(i, near[0])
                changed = True
        small = sorted((k for k in range(len(b)) if 0 < n[k] < least), key=lambda k: (-n[k], k))
        for i in small:
            for j in small:
                if n[i] > 0 and n[j] > 0 and n[i] < least and able(j, i):
                    move(j, i)
                    changed = True
        if not changed:
            break
    return b.assign(to=to, n_after=[n[t] if k == t else 0 for k, t in enumerate(to)])


def merge_buckets(df: DataFrame, pool: str) -> DataFrame:
    """``merge_small_buckets`` for each pool; rows are bucket counts, so groups are small whatever the data's size."""
    schema = f"{pool} string, tier int, width int, height int, n long, to long, n_after long"

    def run(key, pdf):
        out = merge_small_buckets(pdf.sort_values(["tier", "width", "height"]))
        return out[[pool, "tier", "width", "height", "n", "to", "n_after"]]

    return df.groupBy(pool).applyInPandas(run, schema)


def shard_plan(counts: dict[int, int], children: dict[int, list[int]], root: int, most: int = 50_000, few: int = 10) -> list[dict]:
    """Shards of a region tree: a region over ``most`` rows is split into its children; what they do not cover is a shard that excludes
    them, while there are at most ``few`` to exclude."""
    out: list[dict] = []

    def walk(r: int) -> None:
        below = [c for c in children.get(r, []) if counts.get(c, 0)]
        if counts.get(r, 0) <= most or not below:
            out.append({"region": r, "exclude": [], "rows": counts.get(r, 0)})
            return
        for c in below:
            walk(c)
        rest = counts[r] - sum(counts[c] for c in below)
        if rest > 0:
            out.append({"region": r, "exclude": sorted(below)[:few] if len(below) <= few else [], "rows": rest if len(below) <= few else counts[r]})

    walk(root)
    return out


def year_bands(count, first: int, last: int, most: int = 50_000) -> list[tuple[int, int]]:
    """Year ranges halved until ``count(first, last)`` fits or one year is left."""
    if count(first, last) <= most or first == last:
        return [(first, last)]
    mid = (first + last) // 2
    return year_bands(count, first, mid, most) + year_bands(count, mid + 1, last, most)

"""Sizes, buckets, scores and other arithmetic on rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Aspect ratio families and the ratios of their buckets at the largest tier.
FAMILIES = {"9:16": 0.5647, "2:3": 0.6667, "4:5": 0.8028, "1:1": 1.0, "5:4": 1.2456, "3:2": 1.5, "16:9": 1.7708}
TIERS = (1024, 768, 512)
UPSCALE = 1.15


def bucket_grid(resolution: int, step: int = 16) -> list[tuple[int, int]]:
    """Sizes on a grid for one resolution: each width from half the side to the side with the tallest height that keeps the area, and
    the same turned."""
    first, area = resolution // 2 // step * step, resolution * resolution
    wide = {(w, area // w // step * step) for w in range(first, resolution + step, step)}
    return sorted(wide | {(h, w) for w, h in wide})


def family_bucket(tier: int, family: str) -> tuple[int, int]:
    """The tier's bucket whose ratio is nearest to the family's."""
    return min(bucket_grid(tier), key=lambda b: abs(b[0] / b[1] - FAMILIES[family]))


def band_score(value: Column, bands: Sequence[tuple[float, int]]) -> Column:
    """The score of the first band, from the highest, whose limit the value reaches; 0 below all. Null stays null."""
    out = None
    for limit, score in sorted(bands, reverse=True):
        out = F.when(value >= limit, score) if out is None else out.when(value >= limit, score)
    return F.when(value.isNotNull(), out.otherwise(0))


def fine_score(value: Column, bands: Sequence[tuple[float, float]]) -> Column:
    """Scores interpolated between band limits, nearing one more above the top band and in proportion below the lowest."""
    b = sorted(bands)
    top_limit, top = b[-1]
    out = F.when(value >= top_limit, top + 1 - F.lit(top_limit) / value)
    for (lo, s0), (hi, s1) in reversed(list(zip(b, b[1:], strict=False))):
        out = out.when(value >= lo, s0 + (value - lo) / (hi - lo) * (s1 - s0))
    return out.when(value.isNotNull(), value / b[0][0] * b[0][1])


def composite(metrics: Sequence[Column]) -> Column:
    """The least of the metrics that there are; 10 without any."""
    return F.coalesce(F.least(*metrics) if len(metrics) > 1 else metrics[0], F.lit(10.0))


def blend(a: Column, b: Column, weight: float) -> Column:
    """Weighted geometric mean of two scores, each at least 1."""
    return F.exp(weight * F.log(F.greatest(a, F.lit(1.0))) + (1 - weight) * F.log(F.greatest(b, F.lit(1.0))))


def nearest_family(ratio: Column) -> Column:
    """The family whose ratio is nearest; the first of equals. Nothing is too wide for one."""
    pairs = F.array(*[F.struct(F.abs(ratio - r).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, r) in enumerate(FAMILIES.items())])
    return F.array_min(pairs)["n"]


def crop_to(width: Column, height: Column, ratio: Column) -> tuple[Column, Column]:
    """The largest part of a picture with a ratio; half-even rounding, at least one pixel."""
    wide = width / height > ratio
    cw = F.when(wide, F.bround(height * ratio)).otherwise(width)
    ch = F.when(wide, height).otherwise(F.bround(width / ratio))
    inside = lambda v, most: F.greatest(F.lit(1), F.least(v, most)).cast("long")
    return inside(cw, width), inside(ch, height)


def crop_box(width: Column, height: Column, cw: Column, ch: Column, ratio: Column) -> tuple[Column, Column]:
    """Left and top of a crop: centred, but a third from the top for upright targets."""
    return F.floor((width - cw) / 2), F.floor((height - ch) * F.when(ratio < 1, 1 / 3).otherwise(0.5))


def crop_cost(width: Column, height: Column, cw: Column, ch: Column) -> Column:
    """Share of the pixels that a crop discards."""
    return 1 - (cw * ch) / (width * height)


def assign_tier(width: Column, height: Column, tiers: Sequence[int] = TIERS) -> Column:
    """``tier, bw, bh, cw, ch`` of the first tier, from the largest, whose bucket the cropped picture fills with at most ``UPSCALE``
    enlargement; null if it is too small for all."""
    number = F.array_min(F.array(*[F.struct(F.abs(width / height - r).alias("d"), F.lit(i).alias("i")) for i, r in enumerate(FAMILIES.values())]))["i"]
    sizes = F.array(*[F.array(*[F.struct(F.lit(t).alias("tier"), *[F.lit(v).alias(k) for k, v in zip(("bw", "bh"), family_bucket(t, n), strict=True)]) for t in sorted(tiers, reverse=True)]) for n in FAMILIES])

    def cropped(b: Column) -> Column:
        cw, ch = crop_to(width, height, b["bw"] / b["bh"])
        return F.struct(b["tier"].alias("tier"), b["bw"].alias("bw"), b["bh"].alias("bh"), cw.alias("cw"), ch.alias("ch"))

    able = F.filter(F.transform(F.get(sizes, number), cropped), lambda b: b["cw"] * b["ch"] >= b["bw"] * b["bh"] / (UPSCALE * UPSCALE))
    return F.get(able, F.lit(0))


def limit_area(width: Column, height: Column, area: int) -> tuple[Column, Column]:
    """A size with the same ratio and at most ``area`` pixels."""
    k = F.sqrt(F.lit(float(area)) / (width * height))
    small = width * height <= area
    return F.when(small, width).otherwise(F.floor(width * k)).cast("long"), F.when(small, height).otherwise(F.floor(height * k)).cast("long")


def jpeg_quality(table: Column, base: Sequence[int]) -> Column:
    """The quality from 1 to 100 whose scaled base quantisation table is nearest by least squares; the smaller of equals."""
    base_col = F.array(*[F.lit(int(v)) for v in base])

    def scaled(q: Column, v: Column) -> Column:
        s = F.when(q < 50, F.floor(F.lit(5000) / q)).otherwise(200 - 2 * q)
        return F.least(F.lit(255), F.greatest(F.lit(1), F.floor((v * s + 50) / 100)))

    def ssd(q: Column) -> Column:
        return F.aggregate(F.zip_with(table, base_col, lambda t, v: (t - scaled(q, v)) * (t - scaled(q, v))), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.lit(100)), lambda q: F.struct(ssd(q).alias("d"), q.alias("q"))))["q"]


def softmax_mass(scores: Column, positives: int) -> Column:
    """Share of the first ``positives`` of all prompts' softmax."""
    top = F.array_max(scores)
    e = F.transform(scores, lambda x: F.exp(x - top))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return total(F.slice(e, 1, positives)) / total(e)


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def stacked(logit: Column, other: Column, mean: float, deviation: float, weights: tuple[float, float, float], hinge: float = 0.0) -> Column:
    """Probability from a probe's logit and a second measure beyond a hinge, as z-score; without the second the probe alone."""
    z = F.greatest((other - mean) / deviation, F.lit(hinge))
    usable = other.isNotNull() & ~F.isnan(other)
    return F.when(usable, logistic(weights[0] + weights[1] * logit + weights[2] * z)).otherwise(logistic(logit))


def box_area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x2"] - b["x1"]) * F.greatest(F.lit(0.0), b["y2"] - b["y1"])


def inside_share(inner: Column, outer: Column) -> Column:
    """Share of a box that lies in another."""
    w = F.least(inner["x2"], outer["x2"]) - F.greatest(inner["x1"], outer["x1"])
    h = F.least(inner["y2"], outer["y2"]) - F.greatest(inner["y1"], outer["y1"])
    return F.try_divide(F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h), box_area(inner))


def intersect_boxes(boxes: Sequence[Column]) -> Column:
    pick = lambda f, k: reduce(lambda a, b: f(a, b), [b[k] for b in boxes])
    return F.struct(pick(F.greatest, "x1").alias("x1"), pick(F.greatest, "y1").alias("y1"), pick(F.least, "x2").alias("x2"), pick(F.least, "y2").alias("y2"))


def align_box(b: Column, grid: int = 8) -> Column:
    """The largest box on the grid inside a box."""
    up, down = (lambda v: F.ceil(v / grid) * grid), (lambda v: F.floor(v / grid) * grid)
    return F.struct(up(b["x1"]).alias("x1"), up(b["y1"]).alias("y1"), down(b["x2"]).alias("x2"), down(b["y2"]).alias("y2"))


def colour_decision(score: Column, low: float, high: float) -> Column:
    """Plain, colour, or in between for a probe to decide."""
    return F.when(score < low, "bw").when(score > high, "color").otherwise("probe")

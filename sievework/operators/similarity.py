"""Similarity joins: cosine neighbours, Hamming distances, verdicts and groups."""

from __future__ import annotations

import itertools
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.operators.graph import connected_components, ensure_checkpoint_dir

#: Most rows of the two sides of a tile of a neighbour search; what a task holds is a tile, a few times over.
TILE = (32_768, 131_072)
#: Rows of the parts of a tile that are compared at once, so that their products stay in a core's cache.
PART = (512, 2048)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The place of each distinct row's first, in that order; all places by distinct row, and where each one's begin (and the end)."""
    whole = np.ascontiguousarray(rows).view(f"V{rows.dtype.itemsize * rows.shape[1]}").ravel()
    _, first, of = np.unique(whole, return_index=True, return_inverse=True)
    order = np.argsort(first)
    turn = np.empty(len(order), np.int64)
    turn[order] = np.arange(len(order))
    of = turn[of]
    return first[order], np.argsort(of, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(order)))])


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Places ``start`` to ``start + count``, one range after the other."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - start, count)


def _first_of_each(row: np.ndarray, far: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` nearest of each row, ties by ``other``; in the order of rows."""
    order = np.lexsort((other, far, row))
    at = row[order]
    new = np.concatenate([[True], at[1:] != at[:-1]])
    start = np.flatnonzero(new)
    return order[np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at)))) < k]


class _Nearest:
    """The ``k`` nearest places of each of ``n`` rows, kept as places come in."""

    def __init__(self, n: int, k: int, none: int):
        self.k, self.far, self.at = k, np.full((n, k), np.inf), np.full((n, k), none, np.int64)

    def add(self, row: np.ndarray, far: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Takes in places and gives the rows that they are for."""
        rows = np.unique(row)
        r, f, a = (np.concatenate(v) for v in ((np.repeat(rows, self.k), row), (self.far[rows].ravel(), far), (self.at[rows].ravel(), at)))
        kept = _first_of_each(r, f, a, self.k)
        self.far[rows], self.at[rows] = f[kept].reshape(-1, self.k), a[kept].reshape(-1, self.k)
        return rows


def _where(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the few true cells, eight cells looked at together."""
    flat = hit.ravel()
    if flat.size % 8:
        return np.nonzero(hit)
    cells = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.divmod(cells[flat[cells]], hit.shape[1])


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows as a loop over doubles gives them, so that equal vectors tie; NaN where one has no length."""
    total = lambda a, b: np.cumsum(a * b, axis=1)[:, -1]
    out = np.empty(len(x))
    for lo in range(0, len(x), 16_384):
        a, b = x[lo : lo + 16_384].astype(np.float64), y[lo : lo + 16_384].astype(np.float64)
        with np.errstate(all="ignore"):
            out[lo : lo + 16_384] = np.clip(total(a, b) / np.sqrt(total(a, a) * total(b, b)), -1, 1)
    return out


def _unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one in single precision, and which rows have no length."""
    with np.errstate(all="ignore"):
        norm = np.sqrt(np.einsum("ij,ij->i", m, m, dtype=np.float64))
        odd = ~(np.isfinite(norm) & (norm > 0))
        out = (m / np.where(odd, 1, norm)[:, None]).astype(np.float32)
    out[odd] = 0
    return out, odd


def _nearest_rows(x: np.ndarray, y: np.ndarray, k: int, floor: float) -> _Nearest:
    """The ``k`` rows of ``y`` nearest to each row of ``x``, the first of equals. Products in single precision leave out what is farther
    than the ``k`` found so far by more than their error; the cosines of the rest decide."""
    (xu, x_odd), (yu, y_odd), slack = _unit(x), _unit(y), max(1e-5, x.shape[1] * 2e-7)
    out = _Nearest(len(x), k, len(y))
    for lo in range(0, len(x), PART[0]):
        part = slice(lo, lo + PART[0])
        least = np.full((len(xu[part]), 1), floor - slack, np.float32)
        for j in range(0, len(y), PART[1]):
            sims = xu[part] @ yu[j : j + PART[1]].T
            if x_odd[part].any():
                sims[x_odd[part]] = np.inf
            if y_odd[j : j + PART[1]].any():
                sims[:, y_odd[j : j + PART[1]]] = np.inf
            if j == 0 and sims.shape[1] >= k:
                least = np.maximum(least, np.partition(sims, -k, axis=1)[:, [-k]] - 3 * slack)
            row, at = _where(sims >= least)
            if len(row):
                cos = _cosines(x[lo + row], y[j + at])
                kept = ~(cos < floor)
                if kept.any():
                    rows = out.add(lo + row[kept], -np.where(np.isnan(cos), np.inf, cos)[kept], j + at[kept])
                    worst = -out.far[rows, -1:]
                    least[rows - lo] = np.maximum(least[rows - lo], np.where(np.isposinf(worst), np.nan, worst - 2 * slack))
    return out


def _in_tiles(queries: DataFrame, base: DataFrame, cut: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides, ``id, v``, with ``g, b``: every group of queries meets every block of the base in one tile. Tiles are bounded, and as
    many as keep the machine busy; a row is sent once for each group or block of the other side."""
    spark = queries.sparkSession
    n, m = queries.count(), base.count()
    cut = cut or max(1, -(-m // TILE[1]))
    groups = max(1, -(-n // TILE[0]), min(-(-n // 1024), -(-3 * spark.sparkContext.defaultParallelism // cut)))
    dealt = lambda d, n, own, other, k: d.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("long")).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long"))))
    return dealt(queries, groups, "g", "b", cut), dealt(base, cut, "b", "g", groups)


def cosine_neighbours(queries: DataFrame, base: DataFrame, ident: str, vector: str, k: int, floor: float = -1.0, skip_self: bool = True, blocks: int | None = None) -> DataFrame:
    """``id, other, cos``: the ``k`` nearest rows of ``base`` by cosine for each query, ties by id, at or above a floor. Exact.

    Groups of queries meet blocks of the base in tiles of bounded size. In a tile equal vectors are one; products of two matrices
    find what may be among the nearest, cosines of those pairs decide, and the winners of the tiles are ranked once more. Work grows
    with queries times base, memory does not. A vector without length has the cosine NaN to all, which is above any number.
    """
    q, b = (d.where(F.col(vector).isNotNull()).select(F.col(ident).alias("id"), F.col(vector).alias("v")) for d in (queries, base))
    q, b = _in_tiles(q, b, blocks)
    most = k + 1 if skip_self else k

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"id": pa.array([], pa.int64()), "other": pa.array([], pa.int64()), "cos": pa.array([], pa.float64())})
        right = right.sort_by("id")
        li, ri = left.column("id").to_numpy().astype(np.int64), right.column("id").to_numpy().astype(np.int64)
        x, y = _matrix(left.column("v")), _matrix(right.column("v"))
        (x_first, x_all, x_start), (y_first, y_all, y_start) = _distinct(x), _distinct(y)
        near = _nearest_rows(x[x_first], y[y_first], most, floor)
        row, place = np.nonzero(near.at < len(y_first))
        far, at = near.far[row, place], near.at[row, place]
        n = np.minimum(np.diff(y_start)[at], most)
        row, far, other = np.repeat(row, n), np.repeat(far, n), ri[y_all[_ranges(y_start[at], n)]]
        kept = _first_of_each(row, far, other, most) if len(row) else np.zeros(0, np.int64)
        row, far, other = row[kept], far[kept], other[kept]
        start = np.searchsorted(row, np.arange(len(x_first) + 1))
        of = np.repeat(np.arange(len(x_first)), np.diff(x_start))
        n = np.diff(start)[of]
        place, who = _ranges(start[of], n), np.repeat(x_all, n)
        got, far, other = li[who], far[place], other[place]
        if skip_self:
            apart = got != other
            who, got, far, other = who[apart], got[apart], far[apart], other[apart]
        kept = _first_of_each(who, far, other, k) if len(who) else np.zeros(0, np.int64)
        return pa.table({"id": got[kept], "other": other[kept], "cos": np.where(np.isneginf(far), np.nan, -far)[kept]})

    near = q.groupBy("g", "b").cogroup(b.groupBy("g", "b")).applyInArrow(pair, "id long, other long, cos double")
    w = Window.partitionBy("id").orderBy(F.desc("cos"), "other")
    return near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def symmetric_pairs(neighbours: DataFrame) -> DataFrame:
    """Each found pair once, smaller id first, with its best cosine."""
    return neighbours.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "cos").groupBy("a", "b").agg(F.max("cos").alias("cos"))


def sign_hash(vector: Column) -> Column:
    """A 64-bit hash of a vector of 64: one bit for each positive component, the first the lowest."""
    bits = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def unsigned_hex_to_long(text: Column) -> Column:
    """16 hex digits as a signed 64-bit integer."""
    return F.conv(text, 16, -10).cast("long")


#: The widest limit at which codes still meet on equal runs of bits; beyond it runs are so short that tiles of all rows cost less.
RUNS_TO = 7
#: Rows of a side of a tile that gives all its close pairs, which can be its square.
PAIRS_TILE = 4096
#: As PART, for codes.
CODES = (512, 8192)


def _close(x: np.ndarray, y: np.ndarray, below: np.ndarray, step: int = 32) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of codes that differ in fewer bits than their row's ``below``, and in how many."""
    found = []
    for lo in range(0, len(x), step):
        d = np.bitwise_count(x[lo : lo + step, None] ^ y[None, :])
        row, at = _where(d < below[lo : lo + step])
        found.append((lo + row, at, d[row, at]))
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def _coded(df: DataFrame, ident: str, code: str) -> DataFrame:
    """``id, v`` of rows with a code; one side of a tile, whose columns the other side's must not be."""
    return df.where(F.col(code).isNotNull()).select(F.col(ident).alias("id"), F.col(code).alias("v"))


def _codes(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in their order, and their codes."""
    t = t.sort_by("id")
    return t.column("id").to_numpy().astype(np.int64), t.column("v").to_numpy().view(np.uint64)


def hamming_pairs(df: DataFrame, ident: str, code: str, most: int) -> DataFrame:
    """``a, b, dist``: all pairs of rows whose 64-bit codes differ in at most ``most`` bits. Exact for any ``most``.

    For a narrow limit codes are cut into ``most + 1`` runs of bits, so a close pair agrees in one; rows meet on equal runs and a pair is
    kept at its first. For a wide one every two blocks of rows meet in a tile of bounded size.
    """
    return _pairs_on_runs(df, ident, code, most) if most <= RUNS_TO else _pairs_in_tiles(df, ident, code, most)


def _pairs_in_tiles(df: DataFrame, ident: str, code: str, most: int) -> DataFrame:
    rows, again = _coded(df, ident, code), _coded(df, ident, code)
    cut = max(-(-df.count() // PAIRS_TILE), min(df.sparkSession.sparkContext.defaultParallelism, 64), 1)
    own, numbers = F.pmod(F.xxhash64("id"), F.lit(cut)).cast("long"), lambda lo, hi: F.explode(F.sequence(lo, hi))
    first = rows.withColumn("g", own).withColumn("h", numbers(F.col("g"), F.lit(cut - 1).cast("long")))
    second = again.withColumn("h", own).withColumn("g", numbers(F.lit(0).cast("long"), F.col("h")))

    def pair(key, left: pa.Table, right: pa.Table) -> pa.Table:
        (li, x), (ri, y) = _codes(left), _codes(right)
        below, out = np.full((len(li), 1), most + 1, np.uint8), ([], [], [])
        for lo in range(0, len(li), CODES[0]):
            for j in range(0, len(ri), CODES[1]):
                row, at, d = _close(x[lo : lo + CODES[0]], y[j : j + CODES[1]], below[lo : lo + CODES[0]])
                a, b = li[lo + row], ri[j + at]
                kept = a < b if key[0].as_py() == key[1].as_py() else a != b
                for part, values in zip(out, (np.minimum(a, b)[kept], np.maximum(a, b)[kept], d[kept]), strict=True):
                    part.append(values)
        a, b, d = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in out)
        return pa.table({"a": a.astype(np.int64), "b": b.astype(np.int64), "dist": d.astype(np.int32)})

    return first.groupBy("g", "h").cogroup(second.groupBy("g", "h")).applyInArrow(pair, "a long, b long, dist int")


def _pairs_on_runs(df: DataFrame, ident: str, code: str, most: int) -> DataFrame:
    runs = min(64, most + 1)
    cut = [(64 * i // runs, 64 * (i + 1) // runs) for i in range(runs)]
    part = lambda c, lo, hi: F.shiftrightunsigned(c, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
    keys = F.array(*[F.struct(F.lit(i).alias("i"), part(F.col(code), lo, hi).alias("k")) for i, (lo, hi) in enumerate(cut)])
    rows = df.select(F.col(ident).alias("id"), F.col(code).alias("c"), F.explode(keys).alias("e")).select("id", "c", "e.i", "e.k")
    a, b = rows.select(F.col("id").alias("a"), F.col("c").alias("ca"), "i", "k"), rows.select(F.col("id").alias("b"), F.col("c").alias("cb"), "i", "k")
    met = a.join(b, ["i", "k"]).where((F.col("a") < F.col("b")) & (hamming(F.col("ca"), F.col("cb")) <= most))
    first = F.lit(runs)
    for i, (lo, hi) in reversed(list(enumerate(cut))):
        first = F.when(part(F.col("ca"), lo, hi) == part(F.col("cb"), lo, hi), i).otherwise(first)
    return met.where(F.col("i") == first).select("a", "b", hamming(F.col("ca"), F.col("cb")).alias("dist"))


def hamming_neighbours(df: DataFrame, ident: str, code: str, k: int, most: int) -> DataFrame:
    """``id, other, dist``: the ``k`` nearest rows of each by the bits that their codes differ in, ties by id, at most ``most`` apart. Exact.

    Tiles as in ``cosine_neighbours``; no more than the winners of a tile leave it, however many pairs are close.
    """
    q, b = _in_tiles(_coded(df, ident, code), _coded(df, ident, code))

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        (li, x), (ri, y) = _codes(left), _codes(right)
        near = _Nearest(len(li), k + 1, len(ri))
        for lo in range(0, len(li), CODES[0]):
            below = np.full((len(x[lo : lo + CODES[0]]), 1), most + 1, np.uint8)
            for j in range(0, len(ri), CODES[1]):
                row, at, d = _close(x[lo : lo + CODES[0]], y[j : j + CODES[1]], below)
                if len(row):
                    rows = near.add(lo + row, d.astype(np.float64), j + at)
                    # Places come in the order of ids, so a later one has to be nearer.
                    below[rows - lo] = np.minimum(most + 1, near.far[rows, -1:])
        row, place = np.nonzero(near.at < len(ri))
        far, other = near.far[row, place], ri[near.at[row, place]]
        apart = li[row] != other
        row, far, other = row[apart], far[apart], other[apart]
        kept = _first_of_each(row, far, other, k) if len(row) else np.zeros(0, np.int64)
        return pa.table({"id": li[row[kept]], "other": other[kept], "dist": far[kept].astype(np.int32)})

    near = q.groupBy("g", "b").cogroup(b.groupBy("g", "b")).applyInArrow(pair, "id long, other long, dist int")
    w = Window.partitionBy("id").orderBy("dist", "other")
    return near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def nearest_pairs(df: DataFrame, ident: str, code: str, k: int, most: int) -> DataFrame:
    """``a, b, dist``: pairs at most ``most`` bits apart that are among the ``k`` nearest of either end, ties by the smaller and then the
    larger id. Of one row's pairs that is the order of the other end's id."""
    near = hamming_neighbours(df, ident, code, k, most)
    return near.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "dist").distinct()


def equal_stars(df: DataFrame, ident: str, key: str) -> DataFrame:
    """Equal rows as stars: the smallest id of each key to every other one. One edge a copy, not all pairs."""
    least = df.groupBy(key).agg(F.min(ident).alias("a"), F.count("*").alias("_n")).where(F.col("_n") > 1).drop("_n")
    return df.select(F.col(ident).alias("b"), key).join(least, key).where(F.col("a") != F.col("b")).select("a", "b")


#: Limits of the rule modes on two distances; a pair matches a mode if one of its rules holds. Fixed values.
MATCH_RULES: dict[str, list[tuple[int, int]]] = {"loose": [(14, 16), (16, 8)], "strict": [(8, 10)], "exact": []}


def rule_holds(mode: str, p: Column, d: Column) -> Column:
    out = F.lit(False)
    for most_p, most_d in MATCH_RULES[mode]:
        out = out | ((p <= most_p) & (d <= most_d))
    return out


def colour_veto(a: Column, b: Column) -> Column:
    """A colour picture against a plain one: the larger value at least 8 and the smaller under a quarter of it."""
    return (F.greatest(a, b) >= 8) & (F.least(a, b) < 0.25 * F.greatest(a, b))


def pair_verdict(hashed: Column, flat: Column, colour: Column, strict: Column, mirror: Column, window: Column) -> Column:
    """The verdict of a pair, strongest reason first: no hash, flat, colour, strict, mirror, window, far."""
    rules = [("UNHASHED", ~hashed), ("FLAT", flat), ("COLOUR", colour), ("HASH", strict), ("MIRROR", mirror), ("WIN", window)]
    out = None
    for name, cond in rules:
        c = F.coalesce(cond, F.lit(False))
        out = F.when(c, name) if out is None else out.when(c, name)
    return out.otherwise("FAR")


def verified(hash_match: Column, inliers: Column, cover: Column, ncc: Column) -> Column:
    """Decision of a feature test; where it ran, it overrides a hash match."""
    passed = (inliers >= 40) & (cover >= 0.36) & (ncc >= 0.5)
    return F.when(inliers.isNotNull(), passed).otherwise(hash_match)


def group_ids(edges: DataFrame, nodes: DataFrame | None = None, ident: str = "id") -> DataFrame:
    """``id, component`` of every node that has edges, or of all nodes; alone a node is its own component."""
    c = connected_components(edges).withColumnRenamed("node", ident)
    return c if nodes is None else nodes.select(ident).join(c, ident, "left").select(ident, F.coalesce("component", ident).alias("component"))


def steps_from(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """``node, root, steps``: breadth-first distance from each start within its component, one join a step until nothing new is reached.

    What a step reaches lies at most one step from the front, so only the last two fronts are looked through for it.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct().checkpoint()
    front = starts.select(F.col("node"), F.col("node").alias("root"), F.lit(0).alias("steps")).checkpoint()
    seen, known = [front], front
    for step in itertools.count(1):
        reach = front.join(both, front.node == both.u).select(F.col("v").alias("node"), "root").distinct()
        new = reach.join(known, ["node", "root"], "left_anti").withColumn("steps", F.lit(step)).checkpoint()
        if new.isEmpty():
            return reduce(DataFrame.unionByName, seen)
        front, known = new, front.unionByName(new)
        seen.append(new)
        if len(seen) > 20:
            seen = [reduce(DataFrame.unionByName, seen).checkpoint()]


def against_base(queries: DataFrame, base: DataFrame, ident: str, vector: str, sure: float, candidate: float, tested: DataFrame | None = None) -> DataFrame:
    """Copies of a reference base: the nearest base row is a copy at ``sure``, from ``candidate`` on if a feature test says so."""
    near = cosine_neighbours(queries, base, ident, vector, 1, skip_self=False)
    if tested is not None:
        near = near.join(tested, ["id", "other"], "left")
    passed = F.coalesce(F.col("passed"), F.lit(False)) if tested is not None else F.lit(False)
    kind = F.when(F.col("cos") >= sure, "copy").when((F.col("cos") >= candidate) & passed, "copy").when(F.col("cos") >= candidate, "candidate").otherwise("new")
    return near.select("id", "other", "cos", kind.alias("kind"))


def vote_shares(neighbours: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """Share of each label among a row's ``k`` neighbours."""
    return neighbours.join(labels.select(F.col("id").alias("other"), "label"), "other").groupBy("id", "label").agg((F.count("*") / k).alias("share"))


def isolation(neighbours: DataFrame) -> DataFrame:
    """One minus the mean cosine of a row's neighbours."""
    return neighbours.groupBy("id").agg((1 - F.avg("cos")).alias("isolation"))


def order_free_key(a: Column, b: Column) -> Column:
    return F.array_join(F.array_sort(F.array(a, b)), "|")


def normalised(vector: Column) -> Column:
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: x / F.when(norm == 0, 1.0).otherwise(norm))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)



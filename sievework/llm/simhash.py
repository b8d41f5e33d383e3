"""SimHash near-duplicate linking by pigeonhole blocks.

A text's 64-bit fingerprint has a bit set where over half of its shingles' hashes have it. Fingerprints are split into blocks such
that any two within the allowed distance agree on some choice of blocks; rows meet on these choices and the distance is verified.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.common import Room, batches_of, ensure_checkpoint_dir, stored, table, text_or_empty, tidy
from sievework.operators.graph import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 3
HOT = 4096


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one text: A-Z lower-cased, words between ASCII white space, word shingles hashed with XXH64.

    Fewer words than a shingle make one shingle of all of them; no word gives zero.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    n = len(words)
    if not n:
        return 0
    h = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = np.array([h(b" ".join(words), seed)], dtype=np.uint64)
    else:
        ends = list(itertools.accumulate(map(len, words), lambda a, x: a + x + 1))
        joined = b" ".join(words)
        starts = [0, *[e + 1 for e in ends[: n - shingle]]]
        hashes = np.array([h(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=True)], dtype=np.uint64)
    m = len(hashes)
    ones = np.zeros(BITS, dtype=np.int64)
    for lo in range(0, m, 65536):
        part = hashes[lo : lo + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > m, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``id, fp`` (signed 64 bits) of every whole text; null is empty. Rows are independent; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in rb.column(1)), dtype=np.uint64, count=rb.num_rows)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _blocks(bits: list[int], count: int) -> list[list[int]]:
    """``bits`` cut into ``count`` nearly equal runs."""
    return [bits[len(bits) * i // count : len(bits) * (i + 1) // count] for i in range(count)]


def _masks(bits: list[int], count: int, distance: int) -> list[int]:
    """A mask for each choice of ``count - distance`` blocks: two values within ``distance`` bits agree under at least one."""
    cut = _blocks(bits, count)
    return [sum(1 << b for i in chosen for b in cut[i]) for chosen in itertools.combinations(range(count), count - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(col: Column, masks: list[int]) -> Column:
    """An array of (mask number, masked value)."""
    return F.array(*[F.struct(F.lit(i).alias("part"), col.bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])


def link_bucket(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``distance`` bits among distinct values, enough to connect what is connected; never all pairs of a large group.

    Small buckets compare each value with those after it that are not yet joined to it. Large ones look up every change of up to
    ``distance`` of the bits in which the bucket's values differ at all.
    """
    x = np.unique(values.astype(np.uint64))
    m = len(x)
    label = np.arange(m)
    a, b = [], []
    varying = [i for i in range(BITS) if (int(np.bitwise_or.reduce(x ^ x[0])) >> i) & 1]
    flips = sum(_choose(len(varying), k) for k in range(1, distance + 1))
    if m <= max(HOT, flips):
        for i in range(m - 1):
            near = np.flatnonzero((np.bitwise_count(x[i + 1 :] ^ x[i]) <= distance) & (label[i + 1 :] != label[i])) + i + 1
            for j in near:
                if label[j] != label[i]:
                    label[label == label[j]] = label[i]
                    a.append(x[i])
                    b.append(x[j])
    else:
        for k in range(1, distance + 1):
            for chosen in itertools.combinations(varying, k):
                y = x ^ np.uint64(sum(1 << c for c in chosen))
                at = np.searchsorted(x, y)
                at[at == m] = 0
                i = np.flatnonzero((x[at] == y) & (x < y))
                j = at[i]
                i, j = i[label[i] != label[j]], j[label[i] != label[j]]
                a.extend(x[i])
                b.extend(x[j])
                while len(i):
                    lo, hi = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
                    np.minimum.at(label, hi, lo)
                    while not np.array_equal(label, label[label]):
                        label = label[label]
                    apart = label[i] != label[j]
                    i, j = i[apart], j[apart]
    return np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def near_links(distinct: DataFrame, distance: int = DISTANCE, blocks: int | None = None) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) within ``distance`` bits, enough for their components.

    With ``distance + 2`` blocks, rows meet on every choice of two equal blocks. A key that more than ``HOT`` fingerprints share
    is cut once more: its rows also meet on choices of the bits that the key leaves open, so a bucket's values differ in few bits.
    """
    masks = _masks(list(range(BITS)), blocks or distance + 2, distance)
    rows = distinct.select("fp", F.explode(_keys(F.col("fp"), masks)).alias("k")).select("fp", "k.part", "k.key")
    hot = rows.groupBy("part", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("part", "key", F.lit(True).alias("hot"))
    rows = rows.join(hot, ["part", "key"], "left")
    finer = None
    for i, m in enumerate(masks):
        sub = _keys(F.col("fp"), [m | s for s in _masks([b for b in range(BITS) if not (m >> b) & 1], 2 * distance, distance)])
        finer = F.when(F.col("part") == i, sub) if finer is None else finer.when(F.col("part") == i, sub)
    same = F.array(F.struct(F.lit(-1).alias("part"), F.col("key").alias("key")))
    rows = rows.select("fp", "part", F.explode(F.when(F.col("hot"), finer).otherwise(same)).alias("s")).select("fp", (F.col("part") * 1000 + F.col("s.part") + 1).alias("part"), F.col("s.key").alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(fps):
            a, b = link_bucket(fps, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        held_part = held_key = None
        held = []
        for rb in batches:
            if not rb.num_rows:
                continue
            fp, part, key = (rb.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edge = np.flatnonzero((part[1:] != part[:-1]) | (key[1:] != key[:-1])) + 1
            cuts = [0, *edge.tolist(), len(fp)]
            runs = np.diff(cuts)
            for i in np.union1d(np.flatnonzero(runs > 1), [0, len(runs) - 1]):
                lo, hi = cuts[i], cuts[i + 1]
                if held and (held_part, held_key) != (part[lo], key[lo]):
                    if sum(map(len, held)) > 1:
                        yield emit(np.concatenate(held))
                    held = []
                if hi == len(fp):
                    held_part, held_key = part[lo], key[lo]
                    held.append(fp[lo:hi].view(np.uint64))
                elif held:
                    yield emit(np.concatenate([*held, fp[lo:hi].view(np.uint64)]))
                    held = []
                else:
                    yield emit(fp[lo:hi].view(np.uint64))
        if held and sum(map(len, held)) > 1:
            yield emit(np.concatenate(held))

    return rows.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(run, "a long, b long")


def near_components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``id, fp, component_id`` for stored ``id, fp`` rows: the smallest id reachable over links of at most ``distance`` bits.

    Equal fingerprints collapse to one row before anything is linked, so a group of copies costs one. Only fingerprints travel.
    """
    ensure_checkpoint_dir(prints.sparkSession)
    distinct = stored(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-distinct")
    roots = connected_components(near_links(distinct, distance)).withColumnRenamed("node", "fp")
    labelled = distinct.join(roots, "fp", "left").select("fp", "least_id", F.coalesce("component", "fp").alias("component"))
    labelled = stored(labelled, "simhash-labelled")
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classes = labelled.join(least, "component").select("fp", "component_id")
    return prints.join(classes, "fp").select("id", "fp", "component_id")


def op9_simhash_components(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    prints = stored(fingerprints(table(spark, sf_dir, "documents")), "simhash-prints")
    out = near_components(prints)
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# Similarity of word shingles, exact. Documents first meet by their fingerprints, on choices of blocks and within the distance, and their
# sets decide. Fingerprints of pairs at 0.8 mostly differ in more bits than any choice of blocks can allow for, so what is still apart is
# brought together in an exact way: every pair of sets with a Jaccard similarity of at least t shares an element among the first
# n - ceil(t * n) + 1 of either, in any one order of all elements (prefix filter): whatever was added, cut or moved and however many
# rows there are. The rest meets on these elements only, common elements come last, and each candidate is decided on the sets.

NEAR = 0.8
#: The share of all hashes that is counted to put common shingles last, in how many documents a shingle is common, and how many of these are
#: told apart at most, the rest standing among the rare ones. They change time, not results.
COUNTED = 0.35
FEW = 3
COMMON = 2_000_000
STOP = np.uint64(int(COUNTED * (1 << 64)))
#: Neighbours in a mixed order that rows which are still apart are compared with before all are. They change time, not results.
MIXED = 6
#: Bits of the parity of a set's hashes, and from how many rows of a key on pairs are looked at by them. They change time, not results.
PARITY = 1024
MANY = 32
#: So many links at most are joined to groups in the driver, 16 bytes each; more take rounds over all executors. It changes time and disk,
#: not results.
LINKS_HERE = 1 << 18
#: Pairs sent at once.
HELD = 65_536
#: Texts and pairs of sets that cross to Python at once.
ROWS_AT_ONCE = 500
NEAR_PAIRS = "a long, b long"


def shingle_set(text: str | None, shingle: int, seed: int = SEED) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles; fewer words than a shingle make one."""
    import xxhash

    h = xxhash.xxh64_intdigest
    ws = (text or "").encode().lower().split()
    n = len(ws)
    if n <= shingle:
        return np.array([h(b" ".join(ws), seed)], dtype=np.uint64)
    ends = list(itertools.accumulate(map(len, ws), lambda a, x: a + x + 1))
    joined = b" ".join(ws)
    starts = [0, *[e + 1 for e in ends[: n - shingle]]]
    return np.array(sorted({h(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=True)}), dtype=np.uint64)


def prefix_of(own: np.ndarray, common: np.ndarray, place: np.ndarray, similarity: float) -> np.ndarray:
    """The elements of a set that a similar set cannot all miss: first those counted as rare, then ``common`` ones (sorted) by ``place``,
    then those that are not counted."""
    late = np.zeros(len(own), dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        late = np.where(common[at] == own, place[at], 0)
    late[np.searchsorted(own, STOP) :] = np.iinfo(np.int64).max
    keep = len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1
    return own[np.lexsort((own, late))[:keep]]


def needed(n, m, similarity: float):
    """Common elements of two sets of ``n`` and ``m`` that are just similar."""
    return np.ceil(similarity / (1 + similarity) * (n + m) - 1e-9)


def parity_of(own: np.ndarray) -> bytes:
    """For each of ``PARITY`` bits whether an odd number of a set's elements fall on it; where those of two sets differ, the sets do."""
    return np.packbits(np.bincount((own & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1).tobytes()


def cross_pairs(node: np.ndarray, comp: np.ndarray, n: np.ndarray, pos: np.ndarray, prev: np.ndarray, first: np.ndarray, similarity: float, parity: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a key's rows from different components that can still be similar, at most about ``HELD`` at once.

    ``pos`` is the key's place in a row's set: where it is the first that both have, what follows it bounds the overlap. ``prev`` is the
    key before it (none where ``first``): rows that agree on that have met there, so a pair is given once for each run of shared keys.
    ``parity`` has a row of 64-bit words for each: two sets differ in at least as many elements as these differ in bits.
    """
    _, inverse, counts = np.unique(comp, return_inverse=True, return_counts=True)
    rank = np.argsort(np.argsort(counts, kind="stable"), kind="stable")[inverse]
    order = np.argsort(rank, kind="stable")
    node, n, left, prev, first, rank = node[order], n[order], (n - pos)[order], prev[order], first[order], rank[order]
    parity = None if parity is None else parity[order]
    stop = np.searchsorted(rank, rank, side="right")
    a, b, size = [], [], 0
    for i in range(int(np.searchsorted(rank, rank[-1]))):
        j = stop[i]
        new = (prev[j:] != prev[i]) | first[j:] | first[i]
        near = np.flatnonzero(new & (np.minimum(left[i], left[j:]) >= needed(n[i], n[j:], similarity))) + j
        if parity is not None and len(near):
            apart = np.bitwise_count(parity[near] ^ parity[i]).sum(axis=1, dtype=np.int64)
            near = near[apart <= n[i] + n[near] - 2 * needed(n[i], n[near], similarity)]
        if len(near):
            a.append(np.full(len(near), node[i]))
            b.append(node[near])
            size += len(near)
            if size >= HELD:
                yield np.concatenate(a), np.concatenate(b)
                a, b, size = [], [], 0
    if size:
        yield np.concatenate(a), np.concatenate(b)


def _common_shingles(rows: DataFrame, total: int, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that more than ``FEW`` documents have, sorted, and their places from the rarest on.

    Of all documents, the shingles with the lowest hashes are counted: where nothing is common, prefixes lie there. The most common are
    told apart, twice as many as there are documents but no more than ``COMMON``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in rb.column(0)]
            h, n = np.unique(np.concatenate([s[: np.searchsorted(s, STOP)] for s in sets]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])
        tidy()

    counts = rows.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > FEW)
    got = counts.orderBy(F.desc("n"), "h").limit(min(COMMON, max(100_000, 2 * total))).toArrow()
    h = got.column("h").to_numpy().view(np.uint64)
    place = np.arange(len(h), 0, -1, dtype=np.int64)
    order = np.argsort(h)
    return h[order], place[order]


def simhash_pairs(prints: DataFrame, room: Room) -> DataFrame:
    """``a, b``: nodes of ``node, n, fp`` rows whose fingerprints are equal, each with the one before it in size, and nodes of fingerprints
    that ``near_links`` links."""
    own = prints.select("fp", "n", "node").distinct()
    equal = own.select("node", F.lag("node").over(Window.partitionBy("fp").orderBy("n", "node")).alias("a")).where("a is not null").select("a", F.col("node").alias("b"))
    distinct = room.stored(own.groupBy("fp").agg(F.min(F.struct("n", "node")).alias("one")).select("fp", F.col("one.node").alias("node")), "near-distinct")
    near = near_links(distinct)
    for c in ("a", "b"):
        near = near.withColumnRenamed(c, "fp").join(distinct, "fp").drop("fp").withColumnRenamed("node", c)
    return equal.unionByName(near.select("a", "b")).where("a <> b")


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = NEAR) -> DataFrame:
    """``id, component_id`` of documents whose sets of word shingles are ``similarity`` alike (Jaccard) or more, and chains of such.

    Exact: no pair at ``similarity`` is left out and none below it is linked. Equal sets collapse first. Then documents are linked by SimHash:
    those whose fingerprints are equal or that ``near_links`` finds within its distance, checked on the sets. The rest of the links joins
    what these leave apart: rows of a key are compared
    with the neighbour in size that they meet most, with the row of their keys that meets most others, and with ``MIXED`` in a mixed
    order, which joins most large groups at a few comparisons a row; then all rows of a key that are still apart are compared with each other. Only pairs of numbers are made for
    that, one for each run of keys that a pair shares, and the sets of candidates are made from their texts to decide them. Rows that share an id, of any type with an order, are one document; rows without one are left out; null
    text is empty; an empty table gives no rows. The result is stored; what led to it is
    deleted.
    """
    room = Room(docs.sparkSession)
    try:
        with batches_of(docs.sparkSession, ROWS_AT_ONCE):
            return stored(_similar(docs, id_col, text_col, shingle, similarity, room), "near-groups")
    finally:
        room.close()


def _similar(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float, room: Room) -> DataFrame:
    spark, stored = docs.sparkSession, room.stored
    ensure_checkpoint_dir(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    total = rows.count()
    common, place = _common_shingles(rows, total, shingle)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for rb in batches:
            for lo in range(0, rb.num_rows, 512):
                part = rb.slice(lo, 512)
                sets = [shingle_set(t.as_py(), shingle) for t in part.column(1)]
                node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED + 1) for s in sets], dtype=np.uint64).view(np.int64)
                first = [prefix_of(s, common, place, similarity).tobytes() for s in sets]
                parity = pa.array([parity_of(s) for s in sets], pa.binary())
                fps = np.array([fingerprint(t.as_py()) for t in part.column(1)], dtype=np.uint64).view(np.int64)
                cols = [part.column(0), pa.array(node), pa.array([len(s) for s in sets], pa.int32()), pa.array(first, pa.binary()), parity, pa.array(fps)]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "node", "n", "first", "parity", "fp"])
        tidy()

    prints = stored(rows.mapInArrow(run, f"id {kind}, node long, n int, first binary, parity binary, fp long"), "near-sets")
    nodes = stored(prints.groupBy("node").agg(F.min("id").alias("least")), "near-nodes")
    alone = prints.join(nodes.select("node", F.col("least").alias("id")), ["node", "id"]).dropDuplicates(["node", "id"])
    marks = min(1 << 27, max(1 << 16, 16 * total))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo in range(0, rb.num_rows, 512):
                part = rb.slice(lo, 512)
                keys = [np.frombuffer(f.as_py(), dtype=np.int64) for f in part.column(2)]
                sizes = [len(k) for k in keys]
                at = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                pos = pa.array(np.concatenate([np.arange(s) for s in sizes]), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), part.column(0).take(at), part.column(1).take(at), pos], names=["key", "node", "n", "pos"])

    met = alone.select("node", "n", "first").mapInArrow(cut, "key long, node long, n int, pos int")
    by_size = Window.partitionBy("key").orderBy("n", "node")
    before = [F.lag(c).over(by_size).alias(f"{c}_before") for c in ("node", "n", "pos")]
    met = met.select("*", *before, F.lead("node").over(by_size).alias("after")).where("node_before is not null or after is not null").drop("after")
    met = stored(met, "near-met")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            keep = []
            for x, y in zip(rb.column(2), rb.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= similarity * (len(x) + len(y) - both) - 1e-9)
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([rb.column(0).filter(keep), rb.column(1).filter(keep)], names=["a", "b"])
        tidy()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(marks, dtype=bool)
        for rb in batches:
            seen[rb.column(0).to_numpy(zero_copy_only=False)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen).tobytes()], pa.binary())], names=["seen"])

    def fetched(asked: DataFrame) -> DataFrame:
        """``node, own``: the sets of these nodes and of few others, from the texts; only rows whose hashed id is marked are read on."""
        spot = lambda c: F.pmod(F.xxhash64(F.lit("spot"), c), F.lit(marks))
        parts = asked.join(nodes, "node").select(spot("least").alias("spot")).coalesce(4).mapInArrow(mark, "seen binary").collect()
        seen = np.zeros(-(-marks // 8), dtype=np.uint8)
        for part in parts:
            seen |= np.frombuffer(part["seen"], dtype=np.uint8)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import xxhash

            for rb in batches:
                at = rb.column(1).to_numpy(zero_copy_only=False)
                texts = rb.column(0).filter(pa.array((seen[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))
                for lo in range(0, len(texts), 512):
                    own = [shingle_set(t.as_py(), shingle).tobytes() for t in texts[lo : lo + 512]]
                    node = np.array([xxhash.xxh64_intdigest(s, SEED + 1) for s in own], dtype=np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(own, pa.binary())], names=["node", "own"])
            tidy()

        return rows.select("text", spot("id").alias("spot")).mapInArrow(read, "node long, own binary").join(asked, "node", "left_semi")

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-pairs")
        sets = fetched(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        x, y = sets.select(F.col("node").alias("a"), F.col("own").alias("x")), sets.select(F.col("node").alias("b"), F.col("own").alias("y"))
        return stored(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(decide, NEAR_PAIRS), f"{name}-links")

    def neighbours(rows: DataFrame, every: bool = False) -> DataFrame:
        """For each node the one (or ``every`` one) that stands before it in most keys, where they share at least half the keys that similar
        ones do."""
        overlap = F.ceil(F.lit(similarity / (1 + similarity)) * (F.col("n") + F.col("n_before")) - 1e-9)
        behind = F.ceil(F.lit(similarity) * F.greatest("n", "n_before") - 1e-9) - 1
        close = rows.where(F.least(F.col("n") - F.col("pos"), F.col("n_before") - F.col("pos_before")) + F.least("pos", "pos_before") >= overlap)
        keys = close.withColumn("least", overlap - behind).groupBy("node", "node_before", "least").agg(F.count("*").alias("keys")).where(2 * F.col("keys") >= F.col("least"))
        best = keys.groupBy("node").agg(F.max_by("node_before", F.struct("keys", "node_before")).alias("a"))
        return (keys.withColumnRenamed("node_before", "a") if every else best).select("a", F.col("node").alias("b"))

    def still_apart(joined: DataFrame) -> DataFrame:
        """Rows of the keys whose rows are not all joined yet."""
        named = met.select("key", "node", "n", "pos").join(joined, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"), "n", "pos")
        all_of = Window.partitionBy("key")
        return named.withColumn("least", F.min("comp").over(all_of)).withColumn("most", F.max("comp").over(all_of)).where("least <> most").drop("least", "most")

    def of_two(pairs: DataFrame, joined: DataFrame) -> DataFrame:
        """Pairs whose rows are not joined yet."""
        for c in ("a", "b"):
            pairs = pairs.join(joined.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")), c, "left")
        return pairs.where(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b")

    links = linked(simhash_pairs(prints, room), "near-prints")
    joined = stored(connected_components(links, few=LINKS_HERE), "near-joined")
    links = links.unionByName(linked(of_two(neighbours(met), joined), "near-first"))
    joined = stored(connected_components(links, few=LINKS_HERE), "near-joined")
    both = F.struct("node", "comp", "n", "pos")
    named = lambda rows: rows.where("comp <> one.comp").select("key", "node", "n", "pos", *[F.col(f"one.{c}").alias(f"{c}_before") for c in ("node", "n", "pos")])

    weighed = still_apart(joined).withColumn("many", F.count("*").over(Window.partitionBy("key"))).withColumn("weight", F.sum("many").over(Window.partitionBy("node")))
    heavy = weighed.withColumn("one", F.max_by(both, F.struct("weight", "node")).over(Window.partitionBy("key")))
    links = links.unionByName(linked(neighbours(named(heavy)), "near-turn"))
    joined = stored(connected_components(links, few=LINKS_HERE), "near-joined")

    mixed = Window.partitionBy("key").orderBy(F.xxhash64("node"), "node")
    some = still_apart(joined).select("*", F.array(*[F.lag(both, k).over(mixed) for k in range(1, MIXED + 1)]).alias("some"))
    some = some.select("key", "node", "comp", "n", "pos", F.explode("some").alias("one")).where(F.col("one").isNotNull())
    links = links.unionByName(linked(neighbours(named(some), True), "near-turn"))
    joined = stored(connected_components(links, few=LINKS_HERE), "near-joined")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []

        def emit():
            if sum(len(h[0]) for h in held) > 1:
                cols = [np.concatenate([h[i] for h in held]) for i in range(6)]
                if (cols[1] != cols[1][0]).any():
                    raw = [p for h in held for p in h[6].to_pylist()]
                    parity = None if None in raw else np.frombuffer(b"".join(raw), dtype=np.uint64).reshape(len(raw), -1)
                    for a, b in cross_pairs(*cols, similarity, parity):
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for rb in batches:
            if not rb.num_rows:
                continue
            key, *cols = (rb.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for lo, hi in itertools.pairwise(cuts):
                if held_key != key[lo]:
                    yield from emit()
                    held_key, held = key[lo], []
                held.append([*[c[lo:hi] for c in cols], rb.column(7).slice(lo, hi - lo)])
        yield from emit()

    before = F.lag("key").over(Window.partitionBy("node").orderBy("pos"))
    left = still_apart(joined).withColumn("many", F.count("*").over(Window.partitionBy("key"))).withColumn("prev", before)
    left = left.select("key", "node", "comp", "n", "pos", F.coalesce("prev", F.lit(0).cast("long")).alias("prev"), F.col("prev").isNull().alias("first"), "many")
    parities = prints.join(nodes.select("node", F.col("least").alias("id")), ["node", "id"]).groupBy("node").agg(F.first("parity").alias("parity"))
    left = left.join(parities, "node", "left").withColumn("parity", F.when(F.col("many") >= MANY, F.col("parity"))).select("key", "node", "comp", "n", "pos", "prev", "first", "parity")
    more = linked(left.repartition("key").sortWithinPartitions("key").mapInArrow(compare, NEAR_PAIRS), "near-rest")
    same = prints.groupBy("id").agg(F.array_sort(F.collect_set("node")).alias("all")).where("size(all) > 1").select(F.col("all")[0].alias("a"), F.explode("all").alias("b"))
    roots = connected_components(links.unionByName(more).unionByName(stored(same, "near-same")), few=LINKS_HERE)
    classes = stored(nodes.join(roots, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component")), "near-classes")
    ids = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = classes.join(ids, "component").select("node", "component_id")
    return prints.select("id", "node").join(classes, "node").groupBy("id").agg(F.min("component_id").alias("component_id"))

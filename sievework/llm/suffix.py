"""Removal of long repeated byte strings by a difference cover of suffixes.

Two suffixes that agree for ``length`` bytes meet, within a period, at positions that both belong to a difference cover. So only the
cover's suffixes are ranked first, by a prefix short enough to lie inside the repeat (``period - 1`` bytes less). Ranking and sorting go
one bucket of suffixes at a time: a bucket holds the suffixes whose prefix key starts with the same bits, from all blocks of text, and
fits in memory. Long ties, suffixes equal over the whole prefix, are settled by these cover ranks: only where the ranks leave a
border open are all suffixes near it sorted by their full ``length`` bytes. Text never moves; keys go out and one bit for each key
comes back.

Suffixes are put in the order of a 64-bit key of their prefix (a random polynomial of its bytes, mixed), not in that of its letters:
only equality matters here, and prefixes themselves would be ``(order + 1) * (length - period + 1) / period`` times the text. Equal
prefixes have equal keys, so no repeat is missed; two that differ and share a key cost a look and cut nothing, because what is cut is
decided on 128-bit digests of the ``length`` bytes themselves.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm.common import Room, batches_of, stored, table, text_or_empty, tidy

LENGTH = 400
ORDER = 13
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
SHORT_KEY = 40
#: Steps whose answers decide what is cut: their keys are digests of the strings.
DECIDING = (2, 4, 5)
#: Documents, and blocks with their replies, that cross to Python at once.
DOCS_AT_ONCE, BLOCKS_AT_ONCE = 1000, 2


@cache
def difference_cover(q: int) -> tuple[int, np.ndarray]:
    """A period q*q+q+1 and q+1 residues of it, 0 among them, whose differences give every residue; q prime.

    The zeros of a third-order linear recurrence of full period over the integers modulo q are such a set; the first recurrence
    whose zeros are is taken.
    """
    period = q * q + q + 1
    for c in itertools.product(range(1, q), range(q), range(q)):
        a, zeros = (0, 0, 1), []
        for i in range(period):
            if a[0] == 0:
                zeros.append(i)
            a = (a[1], a[2], (c[0] * a[0] + c[1] * a[1] + c[2] * a[2]) % q)
        if len(zeros) == q + 1 and len({(x - y) % period for x in zeros for y in zeros}) == period:
            return period, np.array(sorted((z - zeros[0]) % period for z in zeros))
    raise ValueError(f"no cover for {q}")


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    base, inverse = 0x9E3779B97F4A7C15 | 1, pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64)
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK_BYTES + (1 << 16))
        out = []
        for b in (base, inverse):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            out.append(np.cumprod(x, dtype=np.uint64))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20_011).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Block:
    """The texts of one block: keys of any prefix at any position, and which positions a document's bounds allow."""

    def __init__(self, blob: bytes, sizes: np.ndarray):
        self.data = np.frombuffer(blob, dtype=np.uint8)
        self.sizes = np.asarray(sizes, dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        n = len(self.data)
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_byte_values()[self.data] * up[:n], dtype=np.uint64, out=self.sums[1:])

    def keys(self, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        h = (self.sums[at + length] - self.sums[at]) * self.down[at]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def digests(self, at: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        """The 128-bit digests (high, low) of the strings at these places, one row each."""
        from xxhash import xxh3_128_digest

        raw, stop = self.data.tobytes(), at + length
        out = np.zeros((len(at), 2), dtype=np.uint64)
        for lo in range(0, len(at), 8192):
            ends = zip(at[lo : lo + 8192].tolist(), stop[lo : lo + 8192].tolist(), strict=True)
            out[lo : lo + 8192] = np.frombuffer(b"".join([xxh3_128_digest(raw[a:b]) for a, b in ends]), dtype=">u8").reshape(-1, 2)
        return out

    def strings(self, at: np.ndarray, length: int | np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct strings at these places as rows (key, digest high, digest low) in order, each sorted place's row, and the order.

        Nearly always keys alone tell a block's strings apart; then the rows' order is that of ``told``.
        """
        keys = self.keys(at, length)
        order = np.argsort(keys, kind="stable")
        digests = self.digests(at[order], length[order] if isinstance(length, np.ndarray) else length)
        keys = keys[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        if (~new[1:] & (digests[1:] != digests[:-1]).any(axis=1)).any():
            again = np.lexsort((digests[:, 1], digests[:, 0], keys))
            order, digests, keys = order[again], digests[again], keys[again]
            new[1:] = (keys[1:] != keys[:-1]) | (digests[1:] != digests[:-1]).any(axis=1)
        return np.concatenate([keys[new, None], digests[new]], axis=1), np.cumsum(new) - 1, order

    def told(self, at: np.ndarray, length: int | np.ndarray, count: int) -> np.ndarray:
        """Each place's row among the ``count`` distinct strings, without digests where keys tell them apart."""
        keys, inverse, _ = _counted(self.keys(at, length), 64)
        if len(keys) == count:
            return inverse
        _, row, order = self.strings(at, length)
        inverse[order] = row
        return inverse

    def sent(self, at: np.ndarray, length: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct strings and whether each is at more than one of these places."""
        rows, row, _ = self.strings(at, length)
        return rows, np.bincount(row, minlength=len(rows)) > 1

    def cover(self, period: int, residues: np.ndarray, length: int) -> np.ndarray:
        """Cover positions whose prefix of ``length`` bytes ends inside the document."""
        inside = np.zeros(period, dtype=bool)
        inside[residues] = True
        parts = []
        for s, n in zip(self.starts.tolist(), self.sizes.tolist(), strict=True):
            m = n - length + 1
            if m > 0:
                grid = (np.arange(0, m, period)[:, None] + residues).ravel()
                parts.append(s + grid[grid < m])
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)

    def full(self, length: int) -> np.ndarray:
        """Which positions start a string of ``length`` bytes inside their document."""
        n = len(self.data)
        change = np.zeros(n + 1, dtype=np.int32)
        room = self.sizes >= length
        np.add.at(change, self.starts[room], 1)
        np.add.at(change, self.ends[room] - length + 1, -1)
        return np.cumsum(change[:n]) > 0

    def short_windows(self, words: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and sizes of all runs of ``words`` whole words inside a document that are under ``length`` bytes."""
        none = np.zeros(0, dtype=np.int64)
        if not len(self.data):
            return none, none
        black = ~((self.data == 32) | ((self.data >= 9) & (self.data <= 13)))
        border = np.zeros(len(self.data) + 1, dtype=bool)
        border[self.starts] = border[self.ends] = True
        first = np.flatnonzero(black & (border[:-1] | ~np.concatenate([[False], black[:-1]])))
        stop = np.flatnonzero(black & (border[1:] | ~np.concatenate([black[1:], [False]]))) + 1
        if len(first) < words:
            return none, none
        at, size = first[: len(first) - words + 1], stop[words - 1 :] - first[: len(first) - words + 1]
        doc = np.searchsorted(self.ends, at, side="right")
        keep = (size < length) & (at + size <= self.ends[doc])
        return at[keep], size[keep]

    def spread(self, at: np.ndarray, back: int, ahead: int | np.ndarray) -> np.ndarray:
        """Bytes from ``back`` before to ``ahead`` after each position, within the position's document."""
        n = len(self.data)
        change = np.zeros(n + 1, dtype=np.int32)
        if len(at):
            doc = np.searchsorted(self.ends, at, side="right")
            np.add.at(change, np.maximum(at - back, self.starts[doc]), 1)
            np.add.at(change, np.minimum(at + ahead, self.ends[doc]), -1)
        return np.cumsum(change[:n]) > 0


def _counted(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    u, inverse, n = np.unique(keys >> np.uint64(64 - bits), return_inverse=True, return_counts=True)
    return u, inverse, n


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows of keys, for each row the place of its like, and how often each occurs.

    Rows that differ in their first key, nearly all that differ, are in order after it is sorted; all keys are only where they do not.
    """
    order = np.argsort(rows[:, 0], kind="stable")
    ordered = rows[order]
    same = ordered[1:, 0] == ordered[:-1, 0]
    if (same & (ordered[1:] != ordered[:-1]).any(axis=1)).any():
        order = np.lexsort(rows.T[::-1])
        ordered = rows[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    place = np.cumsum(new) - 1
    inverse = np.empty(len(order), dtype=np.int64)
    inverse[order] = place
    return ordered[new], inverse, np.bincount(place, minlength=int(new.sum()))


def _pack(keys: np.ndarray, width: int) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpack(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


@dataclass(frozen=True)
class Method:
    """Parameters of a run; ``bucket_bits`` leading key bits name a bucket."""

    length: int
    order: int
    bucket_bits: int
    words: int | None = None

    @property
    def period(self) -> int:
        return difference_cover(self.order)[0]

    @property
    def prefix(self) -> int:
        return self.length - self.period + 1

    def key_bits(self, step: int) -> int:
        return self.bucket_bits + SHORT_KEY if step in (1, 3) else 64

    def rows(self, keys: np.ndarray, flags: np.ndarray, step: int):
        """Sorted distinct keys or digests cut by bucket: ``(bucket, keys, flags)``."""
        if step in DECIDING:
            bucket = (keys[:, 0] >> np.uint64(64 - self.bucket_bits)).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
            for a, b in itertools.pairwise(cuts):
                if b > a:
                    yield int(bucket[a]), keys[a:b, 1:].astype("<u8").tobytes(), np.packbits(flags[a:b]).tobytes()
            return
        low = self.key_bits(step) - self.bucket_bits
        width = -(-low // 8)
        bucket = (keys >> np.uint64(low)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(keys)]
        mask = np.uint64((1 << low) - 1)
        for a, b in itertools.pairwise(cuts):
            if b > a:
                yield int(bucket[a]), _pack(keys[a:b] & mask, width), np.packbits(flags[a:b]).tobytes()

    def replies(self, reply) -> np.ndarray:
        """The bits of sorted distinct keys from the rows that the buckets sent back."""
        parts = [np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), count=r["n"]) for r in sorted(reply or [], key=lambda r: r["bucket"])]
        return np.concatenate(parts).astype(bool) if parts else np.zeros(0, dtype=bool)

    def ask(self, b: Block, replies: list, step: int):
        """The keys that a block sends in a step, with their flags, or after the last step which bytes repeat.

        1: prefixes of cover suffixes (flag: twice in the block). 2: full strings at cover suffixes whose rank is shared, and at
        documents' last places. 3: ranks again (flag: a border near one is open). 4: full strings at all places near open ranks.
        5: runs of ``words`` words that are shorter than ``length``, which longer strings do not cover.
        """
        if step == 5:
            return b.sent(*b.short_windows(self.words, self.length))
        period, residues = difference_cover(self.order)
        cover = b.cover(period, residues, self.prefix)
        ranks, inverse, n = _counted(b.keys(cover, self.prefix), self.key_bits(1))
        if step == 1:
            return ranks, n > 1
        shared = self.replies(replies[0])[inverse]
        tied, tied_rank = cover[shared], inverse[shared]
        full = b.full(self.length)
        doc = np.unique(np.searchsorted(b.ends, tied, side="right"))
        last = b.ends[doc] - self.length
        last = last[last >= b.starts[doc]]
        known = np.unique(np.concatenate([tied[full[tied]] if len(tied) else tied, last]))
        if step == 2:
            return b.sent(known, self.length)
        again = self.replies(replies[1])
        sure = known[again[b.told(known, self.length, len(again))]]
        covered = b.spread(sure, 0, self.length)
        near = b.spread(tied, period - 1, 1) & full
        bare = np.concatenate([[0], np.cumsum(~covered)])
        at = np.flatnonzero(near)
        open_at = at[bare[at + self.length] != bare[at]]
        is_open = np.zeros(len(b.data) + 1, dtype=np.int64)
        is_open[open_at + 1] = 1
        upto = np.cumsum(is_open)
        low = np.maximum(tied - period + 1, b.starts[np.searchsorted(b.ends, tied, side="right")]) if len(tied) else tied
        wanted = upto[tied + 1] > upto[low]
        flags = np.zeros(len(ranks), dtype=bool)
        flags[tied_rank[wanted]] = True
        sent = np.unique(tied_rank)
        if step == 3:
            return ranks[sent], flags[sent]
        open_rank = np.zeros(len(ranks), dtype=bool)
        open_rank[sent] = self.replies(replies[2])
        zone = np.flatnonzero(b.spread(tied[open_rank[tied_rank]], period - 1, 1) & full)
        if step == 4:
            return b.sent(zone, self.length)
        again = self.replies(replies[3])
        found = zone[again[b.told(zone, self.length, len(again))]]
        covered |= b.spread(found, 0, self.length)
        if self.words:
            at, size = b.short_windows(self.words, self.length)
            again = self.replies(replies[4])
            again = again[b.told(at, size, len(again))]
            covered |= b.spread(at[again], 0, size[again])
        return covered, None


def _settle(table_: pa.Table, width: int, any_flag: bool) -> pa.Table:
    """Sorts one bucket and answers each of its rows with a bit a key: met elsewhere, or (``any_flag``) flagged anywhere."""
    if width == 16:
        keys = [np.frombuffer(k.as_buffer(), dtype="<u8").reshape(-1, 2) for k in table_.column("keys")]
    else:
        keys = [_unpack(k.as_py(), width) for k in table_.column("keys")]
    flags = [np.unpackbits(np.frombuffer(f.as_py(), dtype=np.uint8), count=len(k)) for f, k in zip(table_.column("flags"), keys, strict=True)]
    every = np.concatenate(keys)
    inverse = _distinct(every)[1] if width == 16 else np.unique(every, return_inverse=True)[1]
    weight = np.concatenate(flags) if any_flag else 1 + np.concatenate(flags)
    hit = (np.bincount(inverse, weights=weight) >= (1 if any_flag else 2))[inverse]
    bits, at = [], 0
    for k in keys:
        bits.append(np.packbits(hit[at : at + len(k)]).tobytes())
        at += len(k)
    return pa.table({"block": table_.column("block"), "bucket": table_.column("bucket"), "n": pa.array([len(k) for k in keys], pa.int32()), "bits": pa.array(bits, pa.binary())})


def _write_blocks(docs: DataFrame, carry: list[str], buckets: int, path: str, name: str) -> DataFrame:
    """Gathers the texts of each input partition to blocks, numbered by partition and place, in a table that is bucketed by number.

    Blocks then join with replies without moving. No shuffle; a task that is repeated writes the same blocks.
    """
    spark = docs.sparkSession
    rest = docs.select(F.struct(*carry).alias("r")).schema["r"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        texts, held, size = [], [], 0

        def emit():
            nonlocal number, texts, held, size
            blob, sizes = b"".join(texts), pa.array([len(t) for t in texts], pa.int64())
            struct_ = pa.concat_arrays(held)
            cols = [pa.array([number], pa.int64()), pa.array([blob], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), sizes), pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), struct_)]
            number, texts, held, size = number + 1, [], [], 0
            return pa.RecordBatch.from_arrays(cols, names=["block", "blob", "sizes", "rest"])

        for rb in batches:
            at = 0
            for i, t in enumerate(rb.column(1)):
                raw = t.as_py().encode()
                texts.append(raw)
                size += len(raw)
                if size >= BLOCK_BYTES or len(texts) >= 200_000:
                    held.append(rb.column(0).slice(at, i + 1 - at))
                    at = i + 1
                    yield emit()
            if at < rb.num_rows:
                held.append(rb.column(0).slice(at))
        if texts:
            yield emit()

    blocks = docs.select(F.struct(*carry).alias("r"), text_or_empty("text").alias("text")).mapInArrow(run, f"block long, blob binary, sizes array<long>, rest array<{rest}>")
    with batches_of(spark, DOCS_AT_ONCE):
        blocks.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def _with_replies(blocks: DataFrame, replies: list[DataFrame]) -> DataFrame:
    out = blocks
    for i, r in enumerate(replies):
        out = out.join(r.groupBy("block").agg(F.collect_list(F.struct("bucket", "n", "bits")).alias(f"reply{i}")), "block", "left")
    return out


def _exchange(blocks: DataFrame, replies: list[DataFrame], method: Method, step: int, room: Room) -> DataFrame:
    """One step: blocks send keys, buckets answer. The answers are stored."""
    count = len(replies)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rb in batches:
            for i in range(rb.num_rows):
                b = Block(rb.column("blob")[i].as_py(), rb.column("sizes")[i].as_py())
                keys, flags = method.ask(b, [rb.column(f"reply{k}")[i].as_py() for k in range(count)], step)
                rows = list(method.rows(keys, flags, step))
                number = rb.column("block")[i].as_py()
                del b, keys, flags
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([number] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "block", "keys", "flags"])
        tidy()

    width = 16 if step in DECIDING else -(-(method.key_bits(step) - method.bucket_bits) // 8)
    sent = _with_replies(blocks, replies).drop("rest").mapInArrow(send, "bucket long, block long, keys binary, flags binary")
    with batches_of(blocks.sparkSession, BLOCKS_AT_ONCE):
        return room.stored(sent.groupBy("bucket").applyInArrow(lambda t: _settle(t, width, step == 3), "block long, bucket long, n int, bits binary"), f"suffix-{step}")


def _runs(mask: np.ndarray) -> np.ndarray:
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


RESULT = "n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"


def find_repeats(docs: DataFrame, length: int = LENGTH, order: int = ORDER, carry: list[str] | None = None, text_col: str = "text", whole_chars: bool = False, words: int | None = None) -> DataFrame:
    """Cuts every byte that a ``length``-byte string covers which also starts anywhere else, in any document; with ``words`` also what
    a run of so many whole words (between ASCII white space) covers that is found elsewhere, however short.

    Returns ``rest`` (the ``carry`` columns), ``n_bytes``, ``n_removed``, ``spans`` (maximal removed runs) and ``kept`` (the remaining
    bytes). With ``whole_chars`` a run keeps the bytes of a character that it only touches. A null text is empty; a document shorter
    than ``length`` keeps all; equal documents of at least ``length`` bytes lose all; an empty table gives no rows. Texts are judged on
    the input, whole, and documents are never joined. The result is stored; blocks, replies and the blocks' catalog entry are gone
    when this returns.
    """
    spark = docs.sparkSession
    carry = carry or ["doc_id"]
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], F.col(text_col).alias("text"))
    names = [f"c{i}" for i in range(len(carry))]
    room, name = Room(spark), f"sievework_blocks_{uuid.uuid4().hex}"
    try:
        out = _cut(source, names, Method(length, order, 0, words), whole_chars, room, name)
        with batches_of(spark, BLOCKS_AT_ONCE):
            done = stored(out.select(*[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(carry)], "n_bytes", "n_removed", "spans", "kept"), "suffix-result")
    finally:
        spark.sql(f"drop table if exists {name}")
        room.close()
    return done


def _cut(source: DataFrame, names: list[str], method: Method, whole_chars: bool, room: Room, name: str) -> DataFrame:
    spark = source.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = _write_blocks(source, names, parts, room.path("blocks"), name)
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    keys = total * (method.order + 1) / method.period * 5
    bits = max(int(2 * parts).bit_length(), int(keys // BUCKET_BYTES + 1).bit_length())
    method = replace(method, bucket_bits=min(bits, 24))
    replies: list[DataFrame] = []
    for step in (1, 2, 3, 4, 5) if method.words else (1, 2, 3, 4):
        replies.append(_exchange(blocks, replies, method, step, room))
    rest, count = dict(blocks.dtypes)["rest"], len(replies)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rb in batches:
            for i in range(rb.num_rows):
                b = Block(rb.column("blob")[i].as_py(), rb.column("sizes")[i].as_py())
                mask, _ = method.ask(b, [rb.column(f"reply{k}")[i].as_py() for k in range(count)], 6)
                n, gone, spans, kept = [], [], [], []
                for s, e in zip(b.starts.tolist(), b.ends.tolist(), strict=True):
                    own = mask[s:e]
                    if whole_chars and own.any():
                        own = _whole(own, b.data[s:e])
                    runs = _runs(own) if own.any() else np.zeros((0, 2), dtype=np.int64)
                    n.append(e - s)
                    gone.append(int(own.sum()))
                    spans.append([{"start": x, "stop": y} for x, y in runs.tolist()])
                    kept.append(b.data[s:e][~own].tobytes())
                struct_ = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                held = rb.column("rest")[i].values
                yield pa.RecordBatch.from_arrays([held, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, struct_), pa.array(kept, pa.binary())], names=["rest", "n_bytes", "n_removed", "spans", "kept"])
        tidy()

    return _with_replies(blocks, replies).mapInArrow(finish, f"rest {rest[len('array<') : -1]}, {RESULT}")


def _whole(mask: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The mask without characters that are not masked whole."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(first) or first[0] != 0:
        first = np.concatenate([[0], first])
    size = np.diff(np.concatenate([first, [len(data)]]))
    return np.repeat(np.minimum.reduceat(mask, first), size)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that occur more than once; ``text`` is what is left, made valid where a cut parts a character."""
    out = find_repeats(table(spark, sf_dir, "documents"))
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), text.alias("text"))

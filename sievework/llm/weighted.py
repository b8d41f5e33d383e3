"""Document fingerprints by consistent weighted sampling.

A text is a bag of words with their counts as weights. For each of ``SAMPLES`` draws every word has two gamma variates and a uniform
one of its own, all from a hash of the word; they place the word's weight on a random grid and give it a value, and the word with the
least value is sampled with its grid cell. Two texts draw the same sample with a probability equal to the generalised Jaccard
similarity of their bags: the sum of the smaller weights over the sum of the larger ones.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import table, text_or_empty

SAMPLES = 128
HELD = 200_000
TOGETHER = 32  # texts whose signatures are made in one call
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draw(words: list[str], weights: np.ndarray, samples: int = SAMPLES) -> tuple[np.ndarray, np.ndarray]:
    """Value (log scale) and 16-bit identity of every (word, weight) in every draw."""
    import xxhash

    seeds = np.array([xxhash.xxh64_intdigest(w, 7) for w in words], dtype=np.uint64)[:, None]
    lanes = np.arange(1, 2 * samples + 1, dtype=np.uint64) * _GOLD
    g, h = _mix(seeds + lanes[:samples]), _mix(seeds + lanes[samples:])
    r = _uniform(g, 1)
    r *= _uniform(g, 22)
    np.negative(np.log(r, out=r), out=r)
    log_c = _uniform(g, 43)
    log_c *= _uniform(h, 1)
    np.log(np.negative(np.log(log_c, out=log_c), out=log_c), out=log_c)
    beta = _uniform(h, 22)
    t = np.log(weights).astype(np.float32)[:, None] / r
    t += beta
    np.floor(t, out=t)
    h ^= t.astype(np.int64).view(np.uint64) * _GOLD
    h *= np.uint64(0xD6E8FEB86659FD93)
    h >>= np.uint64(48)
    t -= beta
    t *= r
    log_c -= t
    log_c -= r
    return log_c, h.astype(np.uint16)


def _uniform(h: np.ndarray, shift: int) -> np.ndarray:
    """A number between 0 and 1 from 21 bits."""
    bits = (h >> np.uint64(shift)).astype(np.int32)
    bits &= np.int32(0x1FFFFF)
    u = bits.astype(np.float32)
    u *= np.float32(2.0**-21)
    u += np.float32(2.0**-22)
    return u


class Sampler:
    """Signatures of texts; the draws of recent (word, count) pairs are held. When there are too many, those that several calls had stay."""

    def __init__(self, samples: int = SAMPLES, held: int = HELD):
        self.samples, self.held = samples, held
        self.values = np.zeros((1024, samples), dtype=np.float32)
        self.names = np.zeros((1024, samples), dtype=np.uint16)
        self.calls = np.zeros(1024, dtype=np.int32)
        self.at: dict = {}  # in the order of the rows
        self.lanes = np.arange(samples)
        self.room = np.empty((1024, samples), dtype=np.float32)

    def _drop(self) -> None:
        """Keeps at most half of what may be held. The words of one text can come in two calls, as it waits for its successor."""
        calls = self.calls[: len(self.at)]
        keep = np.flatnonzero(calls > 2)
        if len(keep) > self.held // 2:
            keep = np.sort(np.argsort(-calls, kind="stable")[: self.held // 2])
        for lo in range(0, len(keep), 4096):  # no row moves to a later place
            part = keep[lo : lo + 4096]
            self.values[lo : lo + len(part)], self.names[lo : lo + len(part)] = self.values[part], self.names[part]
        keys = list(self.at)
        self.at = {keys[i]: n for n, i in enumerate(keep.tolist())}
        self.calls[:] = 0

    def _learn(self, keys: list) -> np.ndarray:
        """Rows for keys that are not held; there has to be room."""
        lo = n = len(self.at)
        while n + len(keys) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            self.names = np.concatenate([self.names, np.zeros_like(self.names)])
            self.calls = np.concatenate([self.calls, np.zeros_like(self.calls)])
        for i in range(0, len(keys), 64):
            part = keys[i : i + 64]
            words = [k if type(k) is str else k[0] for k in part]
            weights = np.array([1.0 if type(k) is str else k[1] for k in part])
            self.values[n : n + len(part)], self.names[n : n + len(part)] = draw(words, weights, self.samples)
            n += len(part)
        self.at.update(zip(keys, range(lo, n), strict=True))
        return np.arange(lo, n)

    def _rows(self, keys: list) -> np.ndarray:
        """The rows of different keys, of which there are at most a quarter of what may be held."""
        rows = np.fromiter(map(self.at.get, keys, repeat(-1)), dtype=np.intp, count=len(keys))
        new = np.flatnonzero(rows < 0)
        if len(new):
            if len(self.at) + len(new) > self.held:
                self._drop()
                return self._rows(keys)
            rows[new] = self._learn([keys[i] for i in new.tolist()])
        self.calls[rows] += 1
        return rows

    def _least(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least value and its identity in every draw."""
        best, out = None, None
        for lo in range(0, len(rows), len(self.room)):
            part = rows[lo : lo + len(self.room)]
            values = np.take(self.values, part, axis=0, out=self.room[: len(part)], mode="clip")
            win = values.argmin(axis=0)
            least, name = values[win, self.lanes], self.names[part[win], self.lanes]
            best, out = (least, name) if best is None else (np.minimum(least, best), np.where(least < best, name, out))
        return best, out

    def signatures(self, texts: list[str]) -> np.ndarray:
        """A row of 16 bits a draw for each text. A text without words is a bag of one empty word.

        Texts are taken together while their pairs are few enough, so that what they share is looked up once and new pairs are drawn in blocks.
        """
        out = np.empty((len(texts), self.samples), dtype=np.uint16)
        most = max(1, self.held // 4)
        group, n, first = [], 0, 0
        for i, text in enumerate(texts):
            bag = Counter(text.split()) or Counter([""])
            keys = [w if c == 1 else (w, c) for w, c in bag.items()]
            if group and n + len(keys) > most:
                self._together(group, out[first:i])
                group, n, first = [], 0, i
            if len(keys) > most:
                best = None
                for lo in range(0, len(keys), most):
                    least, name = self._least(self._rows(keys[lo : lo + most]))
                    best, out[i] = (least, name) if best is None else (np.minimum(least, best), np.where(least < best, name, out[i]))
                first = i + 1
            else:
                group.append(keys)
                n += len(keys)
        self._together(group, out[first:])
        return out

    def _together(self, group: list[list], out: np.ndarray) -> None:
        keys = list(dict.fromkeys(chain.from_iterable(group)))
        at = dict(zip(keys, self._rows(keys).tolist(), strict=True))
        for i, part in enumerate(group):
            out[i] = self._least(np.fromiter(map(at.__getitem__, part), dtype=np.intp, count=len(part)))[1]

    def signature(self, text: str) -> np.ndarray:
        """16 bits a draw."""
        return self.signatures([text])[0]


@cache
def _sampler(samples: int) -> Sampler:
    """One for each Python worker."""
    return Sampler(samples)


def edited(text: str, following: str) -> str:
    """The text with its last quarter (rounded down, code points) replaced by as many of the following text's first."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def with_following(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Rows by ranges of the id, each range's first row also at the end of the range before it (the first of all at the very end).

    Columns ``bucket, tail, key, id, text``, sorted within partitions so that each row's successor follows it. Ids are ordered as numbers,
    null first; rows with one id by text. Only range borders reach the driver, a few for each shuffle partition, and texts are
    shuffled once.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("key"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = buckets or 6 * parts
    cuts = base.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n).alias("c")).first()["c"] if n > 1 else []
    cuts = sorted(set(cuts or []))
    if cuts:
        edges = F.array(*[F.lit(int(c)) for c in cuts])
        steps = len(cuts).bit_length()

        def halve(acc, _):
            mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
            right = F.get(edges, mid) < F.col("key")
            done = acc["lo"] >= acc["hi"]
            return F.struct(F.when(~done & right, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(~done & ~right, mid).otherwise(acc["hi"]).alias("hi"))

        found = F.aggregate(F.sequence(F.lit(1), F.lit(steps + 1)), F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")), halve, lambda acc: acc["lo"])
    else:
        found = F.lit(0)
    keys = base.select("key").withColumn("bucket", found)
    firsts = sorted(tuple(r) for r in keys.groupBy("bucket").agg(F.min("key")).collect())
    before = [(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))]
    borders = spark.createDataFrame(before, "key long, _before int")
    placed = base.withColumn("bucket", found).join(F.broadcast(borders), "key", "left")
    places = F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("tail")), F.struct(F.col("_before").alias("b"), F.lit(1).alias("tail")))
    out = placed.select("key", "id", "text", F.explode(places).alias("p")).where(F.col("p.b").isNotNull())
    out = out.select(F.col("p.b").alias("bucket"), F.col("p.tail").alias("tail"), "key", "id", "text")
    return out.repartition(parts, "bucket").sortWithinPartitions("bucket", "tail", "key", "text")


RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, and its likeness to that and to the next document.

    A null text is empty; empty texts are alike; the only document of a table is its own successor; repeated rows follow each other.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(samples)
        last = None  # id, text, signature of the row that waits for its successor

        def settle(group: list, out: list) -> None:
            """Appends the row before each of these (tail, id, text, whether it follows the row before) that it follows."""
            nonlocal last
            owns = [text for _, _, text, _ in group]
            before = [last[1] if last else "", *owns[:-1]]
            changed = [edited(a, b) for a, b, g in zip(before, owns, group, strict=True) if g[3]]
            sigs = sampler.signatures(owns + changed)
            done = zip(changed, sigs[len(owns) :], strict=True)
            for (tail, i, text, follows), sig in zip(group, sigs[: len(group)], strict=True):
                if follows:
                    j, own, mine = last
                    new, theirs = next(done)
                    row = (j, len(own), hashlib.sha256(new.encode()).hexdigest(), mine.tobytes().hex(), theirs.tobytes().hex(), float((mine == theirs).mean()), float((mine == sig).mean()))
                    for col, v in zip(out, row, strict=True):
                        col.append(v)
                last = None if tail else (i, text, sig)

        waits = None  # the bucket of the row that waits
        for rb in batches:
            out = [[] for _ in range(7)]
            group, chars = [], 0
            for bucket, tail, i, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(3).to_pylist(), rb.column(4), strict=True):
                follows = waits is not None and waits == bucket
                if tail and not follows:
                    continue  # a range's border row once more
                waits = None if tail else bucket
                group.append((tail, i, text.as_py(), follows))
                chars += len(group[-1][2])
                if len(group) == TOGETHER or chars > 1_000_000:
                    settle(group, out)
                    group, chars = [], 0
            if group:
                settle(group, out)
            kinds = (rb.schema.field(3).type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return with_following(docs, id_col, text_col).mapInArrow(run, f"id {kind}, {RESULT}")


def generalised_jaccard(a: str, b: str) -> float:
    """The similarity that fingerprints estimate."""
    x, y = Counter(a.split()) or Counter([""]), Counter(b.split()) or Counter([""])
    words = x.keys() | y.keys()
    return sum(min(x[w], y[w]) for w in words) / math.fsum(max(x[w], y[w]) for w in words)


def op6_weighted_sampling(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return fingerprint_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")

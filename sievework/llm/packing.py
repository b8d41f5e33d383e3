"""Best-fit packing of token sequences by patterns fitted with non-negative least squares.

Only lengths matter to a packing, so it is planned on their histogram, whose size the sequence length bounds, and never on rows.
Patterns of up to three lengths that fill a sequence are enumerated on a coarse grid, their repeat counts are fitted to the
histogram by non-negative least squares and rounded down, and what is left is packed best-fit into the remaining gaps. The plan is
a short list of runs; each piece finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import itertools
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievework.llm.common import kept, stored, table, text_or_empty, tidy

LIMIT = 4096
EOS = 1
GRIDS = (16, 32, 64)
WORDS_HELD = 1_000_000
PARTS_HELD = 1_000_000
#: Stored with the pieces: runs of rows as they came, so that a row repeated without end falls to many groups when ranks are counted.
SPREAD = "_spread"
#: How the vocabulary's tokenizer cuts a word before it merges (its own pattern).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
#: Characters that ``str.split`` takes for white space and the tokenizer does not.
NO_SPACE = "\x1c\x1d\x1e\x1f"


class Held(dict):
    """What is known of words; asking for one that is not gives a line break and notes it in ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> str:
        self.new.append(word)
        return "\n"


class WordTokenizer:
    """Ids of whole texts, each distinct part tokenised once while it is held.

    This vocabulary's tokenizer drops white space and never merges over the cuts of ``PRETOKEN``, so a text's ids are those of its
    parts in turn. Texts that this is not sure for go to the tokenizer whole. Ids are held as strings, a character above ``base`` for
    each, so that words and texts are put together and taken apart by string functions. Lower case goes letter by letter, as the
    tokenizer's does, and before the cuts. Both caches are emptied when full, which costs time and changes nothing.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = regex.compile("|".join(regex.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()) or r"(?!)")
        self.whole = Tokenizer.from_file(path)
        self.marks, self.assigned = regex.compile(r"\p{M}"), set()
        self.tok.encode_special_tokens = True
        self.space = regex.compile(rf"[^\S{NO_SPACE}]+")
        self.cut = regex.compile(rf"{PRETOKEN}|\n")
        vocab = self.tok.get_vocab()
        self.end = np.zeros(max(vocab.values()) + 1, dtype=bool)
        #: Two bytes an id where that keeps clear of surrogates.
        self.base, self.codec, self.unit = (256, "utf-16-le", "<u2") if len(self.end) + 256 <= 0xD800 else (1 << 16, "utf-32-le", "<u4")
        for piece, i in vocab.items():
            self.end[i] = piece.endswith("</w>")
        self.words = Held()
        self.parts: dict[str, str] = {"\n": "\n"}

    def _learn_parts(self, parts: list[str]) -> None:
        letters = [p for p in parts if p.isalpha()]
        ids = np.array(self.tok.encode(" ".join(letters), add_special_tokens=False).ids if letters else [], dtype="<u4")
        stops = np.flatnonzero(self.end[ids]) + 1 if len(ids) else np.array([], dtype=np.int64)
        if len(stops) == len(letters):
            every, stops = (ids + self.base).astype(self.unit).tobytes().decode(self.codec), stops.tolist()
            self.parts.update(zip(letters, [every[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=False)], strict=True))
            parts = [p for p in parts if p not in self.parts]
        for p, e in zip(parts, self.tok.encode_batch_fast(parts, add_special_tokens=False), strict=True):
            self.parts[p] = "".join([chr(i + self.base) for i in e.ids])

    def _apart(self, text: str, plain: str) -> bool:
        """Whether a text spells an added token, or has characters on which versions of Unicode differ: unassigned ones, and marks that are
        put in order."""
        if self.added.search(text):
            return True
        if text.isascii():
            return False
        unseen = set(text).difference(self.assigned)
        if any(unicodedata.category(c) == "Cn" for c in unseen):
            return True
        self.assigned |= unseen
        return (plain != text or "İ" in text) and self.marks.search(plain) is not None

    def _words(self, text: str) -> list[str]:
        return [w for w in self.space.split(text) if w] if any(c in text for c in NO_SPACE) else text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [s if s.isascii() or unicodedata.is_normalized("NFC", s) else unicodedata.normalize("NFC", s) for s in texts]
        whole = {i: np.array(self.whole.encode(s, add_special_tokens=False).ids, dtype="<u4") for i, s in enumerate(texts) if self._apart(s, plain[i])}
        lists = [[] if i in whole else self._words(s) for i, s in enumerate(plain)]
        if len(self.words) > WORDS_HELD:
            self.words.clear()
        if len(self.parts) > PARTS_HELD:
            self.parts = {"\n": "\n"}
        word, found, asked = self.words.__getitem__, [], [0]
        for ws in lists:
            found.append("".join(map(word, ws)))
            asked.append(len(self.words.new))
        if asked[-1]:
            missed, self.words.new = self.words.new, []
            new = list(set(missed))
            flat = self.cut.findall("\n".join(new).replace("Σ", "σ").lower())
            self._learn_parts(list(set(flat).difference(self.parts)))
            self.words.update(zip(new, "".join(map(self.parts.__getitem__, flat)).split("\n"), strict=True))
            for i, (a, b) in enumerate(itertools.pairwise(asked)):
                if b > a:
                    first, *rest = found[i].split("\n")
                    found[i] = "".join([first, *itertools.chain.from_iterable(zip(map(word, missed[a:b]), rest, strict=True))])
        return [whole[i] if i in whole else np.frombuffer(s.encode(self.codec), dtype=self.unit).astype("<u4") - np.uint32(self.base) for i, s in enumerate(found)]


def token_pieces(docs: DataFrame, tokenizer: str, limit: int = LIMIT, eos: int = EOS, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` (and ``ids``): each document's ids plus ``eos``, cut every ``limit`` tokens.

    A null text is empty and gives ``eos`` alone, a document of one piece. Rows are independent; no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"tokenizer {tokenizer}"
        tok = kept(name, lambda: WordTokenizer(tokenizer))
        tail = np.array([eos], dtype="<u4")
        for rb in batches:
            for lo in range(0, rb.num_rows, 512):
                part = rb.slice(lo, 512)
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, e in enumerate(tok.encode(part.column(1).to_pylist())):
                    e = np.concatenate([e, tail])
                    for k, at in enumerate(range(0, len(e), limit)):
                        cut = e[at : at + limit]
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(len(cut))
                        crc.append(zlib.crc32(cut))
                        if with_ids:
                            ids.append(cut)
                cols = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
        tidy(keep=name)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    scale = max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds):
        w = a.T @ (b - a @ x)
        w[free] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= 1e-9 * scale:
            break
        free[j] = True
        while True:
            z = np.zeros(n)
            z[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (z <= 0)
            if not low.any():
                x = z
                break
            step = min(1.0, float(np.min(x[low] / np.maximum(x[low] - z[low], 1e-300))))
            x = x + step * (z - x)
            x[free & (x <= 1e-12 * scale)] = 0.0
            free &= x > 0
            if not free.any():
                break
    return x


class Plan:
    """Runs of equal sequences and the slots that pieces of each length take in them.

    A slot row: pieces of ``length`` with ranks from ``rank`` on, ``count`` in all, ``per`` side by side in each sequence from
    ``sequence`` on, the first at ``offset``.
    """

    def __init__(self, limit: int):
        self.limit, self.sequences = limit, 0
        self.used: dict[int, int] = {}
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]
        self.open = np.zeros(limit + 1, dtype=bool)

    def take(self, length: int, sequence: int, runs: int, per: int, offset: int) -> None:
        rank = self.used.get(length, 0)
        self.rows.append((length, rank, runs * per, per, sequence, offset))
        self.used[length] = rank + runs * per

    def leave(self, gap: int, sequence: int, runs: int) -> None:
        if gap and runs:
            self.gaps[gap].append((sequence, runs))
            self.open[gap] = True

    def pattern(self, lengths: list[int], runs: int) -> None:
        at = 0
        for length in lengths:
            self.take(length, self.sequences, runs, 1, at)
            at += length
        self.leave(self.limit - at, self.sequences, runs)
        self.sequences += runs

    def best_fit(self, length: int, count: int) -> None:
        """Places pieces of one length, each into the smallest gap that holds it, else into new sequences."""
        while count:
            wide = np.flatnonzero(self.open[length:])
            if not len(wide):
                per = self.limit // length
                runs, rest = divmod(count, per)
                for r, p in ((runs, per), (1 if rest else 0, rest)):
                    if r:
                        self.take(length, self.sequences, r, p, 0)
                        self.leave(self.limit - p * length, self.sequences, r)
                        self.sequences += r
                return
            gap = length + int(wide[0])
            sequence, runs = self.gaps[gap].pop()
            self.open[gap] = bool(self.gaps[gap])
            per = min(gap // length, max(1, count // runs))
            fill = min(runs, count // per)
            self.take(length, sequence, fill, per, self.limit - gap)
            self.leave(gap - per * length, sequence, fill)
            self.leave(gap, sequence + fill, runs - fill)
            count -= fill * per


def _patterns(units: int) -> list[tuple[int, ...]]:
    """All ways to fill ``units`` grid cells exactly with one, two or three parts."""
    two = [(units - i, i) for i in range(1, units // 2 + 1)]
    three = [(units - i - j, j, i) for i in range(1, units // 3 + 1) for j in range(i, (units - i) // 2 + 1)]
    return [(units,), *two, *three]


def plan_packing(histogram: dict[int, int], limit: int = LIMIT, grids: tuple[int, ...] = GRIDS) -> Plan:
    """The packing of a length histogram; the fewest sequences over the given grids of length classes."""
    plans = [_plan(histogram, limit, min(g, limit)) for g in grids]
    return min(plans, key=lambda p: p.sequences)


def _plan(histogram: dict[int, int], limit: int, units: int) -> Plan:
    left = np.zeros(limit + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan = Plan(limit)
    lengths = np.arange(limit + 1)
    cell = -(-lengths * units // limit)
    want = np.bincount(cell, weights=left, minlength=units + 1)[1:]
    patterns = _patterns(units)
    a = np.zeros((units, len(patterns)))
    for j, p in enumerate(patterns):
        for c in p:
            a[c - 1, j] += 1
    repeats = np.floor(nnls(a, want) + 1e-6).astype(np.int64)
    of = [np.flatnonzero(cell == c) for c in range(units + 1)]
    for j in np.flatnonzero(repeats):
        runs = int(repeats[j])
        while runs:
            chosen, need = [], {}
            for c in patterns[j]:
                full = [int(x) for x in of[c][::-1] if left[x] > need.get(int(x), 0)]
                if not full:
                    break
                chosen.append(full[0])
                need[full[0]] = need.get(full[0], 0) + 1
            if len(chosen) < len(patterns[j]):
                break
            n = min(runs, *(int(left[x]) // k for x, k in need.items()))
            plan.pattern(chosen, n)
            for x, k in need.items():
                left[x] -= n * k
            runs -= n
    for length in np.flatnonzero(left)[::-1]:
        plan.best_fit(int(length), int(left[length]))
    return plan


def place(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces (``id, piece, length`` and more).

    The driver gets the histogram of at most ``limit`` lengths. Ranks within a length are counted in salted groups, whose sizes
    are summed before anything is ranked, so a length that a third of all pieces share is no single task.
    """
    spark = pieces.sparkSession
    histogram = {int(n): int(c) for n, c in pieces.groupBy("length").count().collect()}
    total = sum(histogram.values())
    plan = plan_packing(histogram, limit)
    salts = max(64, total // 50_000)
    slots = np.array(sorted(plan.rows), dtype=np.int64).reshape(-1, 6)
    shift = int(max(histogram.values(), default=1)).bit_length() + 1
    keys = (slots[:, 0] << shift) + slots[:, 1]

    names = [c for c in pieces.columns if c != SPREAD]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("id", "piece", "start", *[c for c in pieces.columns if c == SPREAD]), F.lit(salts)).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy("length", "_salt").orderBy("id", "piece")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(sizes, ["length", "_salt"]).withColumn("_rank", (F.col("_rank") + F.col("_before")).cast("long")).drop("_salt", "_before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            length = rb.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = rb.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            row = slots[np.searchsorted(keys, (length << shift) + rank, side="right") - 1] if len(length) else slots[:0]
            k = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays([*[rb.column(c) for c in names], pa.array(row[:, 4] + k // np.maximum(row[:, 3], 1)), pa.array(row[:, 5] + k % np.maximum(row[:, 3], 1) * length)], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != SPREAD)
    return ranked.select(*names, "_rank").mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT, eos: int = EOS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents into few sequences of at most ``limit`` tokens: one row per piece with its place.

    Only documents longer than ``limit`` are cut. Texts are read once; the stored pieces hold no text. A null id is an id like any
    other, repeated rows are packed once each, an empty table gives no rows.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    pieces = token_pieces(docs, tokenizer, limit, eos, id_col, text_col).withColumn(SPREAD, F.expr("monotonically_increasing_id() div 4096"))
    return place(stored(pieces, "pieces"), limit)


def op1_pattern_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    out = pack_documents(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

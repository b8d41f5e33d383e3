"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over all pieces reports, position by position, every piece that ends there (its output links lead from a piece
to the shorter ones that end with it); one pass relaxes the best score of each position. Characters that no piece covers become the
model's byte pieces.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import table, text_or_empty

SPACE = "▁"
HELD = 400_000
#: What a character without a piece costs below the worst piece.
UNKNOWN_PENALTY = 10.0


class HeldChunks(dict):
    """Parts of texts with their ids and score; looks up without a call for each, makes what is missing and holds it where it is short."""

    def __init__(self, make: Callable[[str], tuple[bytes, float]]):
        super().__init__()
        self.make = make

    def __missing__(self, chunk: str) -> tuple[bytes, float]:
        got = self.make(chunk)
        if len(chunk) <= 64:
            self[chunk] = got
        return got


class PieceModel:
    """Pieces, scores and byte pieces of a model file; encodes and decodes without loss.

    The text gets a space in front; spaces become the model's mark. A literal mark is written as bytes, so decoding cannot confuse it
    with a space.
    """

    def __init__(self, path: str, held: int = HELD):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts: list[bytes] = []
        self.byte_ids = [-1] * 256
        self.unknown = sp.unk_id()
        normal, worst = {}, 0.0
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.texts.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.texts.append(b"")
            else:
                normal[piece] = (i, sp.get_score(i))
                worst = min(worst, sp.get_score(i))
                self.texts.append(piece.replace(SPACE, " ").encode())
        self.floor = worst - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in normal.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        assert not any(re.search(rf"[^{SPACE}]{SPACE}", p) for p in normal), "a piece has a space inside"
        self.lone = "".join(c for c in "\n\r\t" if not any(c in p for p in normal))
        keep = f"[^ {re.escape(self.lone)}]"
        self.cut = re.compile(f"[{re.escape(self.lone)}]| *{keep}+| +" if self.lone else " *[^ ]+| +")
        self.cache = HeldChunks(self._chunk)
        self.held = held

    def viterbi(self, marked: str) -> tuple[list[int], float]:
        """Ids and score of the best segmentation of a text whose spaces are marks and whose literal marks are NUL-wrapped bytes."""
        n, floor = len(marked), self.floor
        best, back, ids = [0.0], [0], [-1]
        at = 0
        for last, (size, score, i) in self.automaton.iter(marked):
            while at <= last:
                best.append(best[at] + floor)
                back.append(at)
                ids.append(-1)
                at += 1
            s = best[at - size] + score
            if s > best[at]:
                best[at], back[at], ids[at] = s, at - size, i
        while at < n:
            best.append(best[at] + floor)
            back.append(at)
            ids.append(-1)
            at += 1
        out, p = [], n
        while p:
            q, i = back[p], ids[p]
            if i >= 0:
                out.append(i)
            else:
                raw = marked[q:p].encode()
                out.extend(self.byte_ids[b] if self.byte_ids[b] >= 0 else self.unknown for b in reversed(raw))
            p = q
        return out[::-1], best[n]

    def _chunk(self, chunk: str) -> tuple[bytes, float]:
        if SPACE not in chunk:
            ids, score = self.viterbi(chunk.replace(" ", SPACE))
            return struct.pack(f"<{len(ids)}i", *ids), score
        ids, score = [], 0.0
        for k, part in enumerate(chunk.split(SPACE)):
            if k:
                ids += [self.byte_ids[b] for b in SPACE.encode()]
                score += self.floor
            if part:
                got, s = self.viterbi(part.replace(" ", SPACE))
                ids += got
                score += s
        return struct.pack(f"<{len(ids)}i", *ids), score

    def encode(self, text: str) -> tuple[np.ndarray, float]:
        """Ids and score of a whole text. Parts that no piece crosses are segmented once while they are held."""
        if not text:
            return np.zeros(0, dtype="<i4"), 0.0
        if len(self.cache) > self.held:
            self.cache.clear()
        got = list(map(self.cache.__getitem__, self.cut.findall(" " + text)))
        score = 0.0
        for g in got:
            score += g[1]
        return np.frombuffer(b"".join([g[0] for g in got]), dtype="<i4"), score

    def decode(self, ids) -> str:
        texts = self.texts
        raw = b"".join([texts[i] for i in (ids.tolist() if isinstance(ids, np.ndarray) else ids)])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", errors="replace")


@cache
def _model(path: str) -> PieceModel:
    """One for each Python worker."""
    return PieceModel(path)


def _ids_column(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int32), pa.int32()))


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, ids, score`` of every whole text. A null text is empty and has no ids. Rows are independent; no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for rb in batches:
            for lo in range(0, rb.num_rows, 512):
                part = rb.slice(lo, 512)
                got = [m.encode(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), _ids_column([g[0] for g in got]), pa.array([g[1] for g in got], pa.float64())], names=["id", "ids", "score"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, f"id {kind}, ids array<int>, score double")


def decode_pieces(encoded: DataFrame, model: str, keep: tuple[str, ...] = ("id", "ids", "score")) -> DataFrame:
    """Adds ``decoded`` to rows with ``ids``; null ids decode to the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for rb in batches:
            texts = [m.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in rb.column("ids")]
            crcs = [zlib.crc32(np.asarray(x.values.to_numpy(zero_copy_only=False), dtype="<i4")) if x.is_valid else 0 for x in rb.column("ids")]
            yield pa.RecordBatch.from_arrays([*[rb.column(c) for c in keep], pa.array(crcs, pa.int64()), pa.array(texts, pa.string())], names=[*keep, "ids_crc32", "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.select(*keep).schema)
    return encoded.select(*keep).mapInArrow(run, f"{fields}, ids_crc32 long, decoded string")


def op10_sentencepiece(spark, sf_dir: str, model: str | None = None) -> DataFrame:
    """All documents encoded and decoded again: ids, their score and digest, and the decoded text's digest."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    out = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), model), model)
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", "ids_crc32", "score", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

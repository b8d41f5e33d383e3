"""Media columns: signature sniffing.

One Aho-Corasick pass over a blob finds every magic byte string; a validator per format then confirms structure and length.
The hit that spans the blob corrects a wrong declared type; validated hits inside it are embedded media that can be carved.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import table, text_or_empty

UNIT = 192
RATE = 8000
TAIL = 16


def _png(b: bytes, at: int) -> int | None:
    p = at + 8
    while p + 12 <= len(b):
        n, kind = struct.unpack_from(">I4s", b, p)
        end = p + 12 + n
        if end > len(b) or (p == at + 8 and kind != b"IHDR"):
            return None
        if zlib.crc32(b[p + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        if kind == b"IEND":
            return end
        p = end
    return None


def _riff(b: bytes, at: int) -> tuple[str, int] | None:
    if at + 12 > len(b):
        return None
    size, form = struct.unpack_from("<I4s", b, at + 4)
    end = at + 8 + size
    kind = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/x-msvideo"}.get(form)
    if kind is None or end > len(b):
        return None
    p, names = at + 12, []
    while p + 8 <= end:
        name, n = struct.unpack_from("<4sI", b, p)
        names.append(name)
        p += 8 + n + (n & 1)
    if p != end or not names or (kind == "audio/wav" and not {b"fmt ", b"data"} <= set(names)):
        return None
    return kind, end


def _gif(b: bytes, at: int) -> int | None:
    if at + 13 > len(b):
        return None
    flags = b[at + 10]
    p = at + 13 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0)
    while p < len(b):
        tag = b[p]
        if tag == 0x3B:
            return p + 1
        if tag == 0x21:
            p += 2
        elif tag == 0x2C and p + 10 <= len(b):
            local = b[p + 9]
            p += 10 + (3 << ((local & 7) + 1) if local & 0x80 else 0) + 1
        else:
            return None
        while p < len(b) and b[p]:
            p += 1 + b[p]
        p += 1
    return None


def _jpeg(b: bytes, at: int) -> int | None:
    p = at + 2
    while p + 4 <= len(b) and b[p] == 0xFF:
        mark = b[p + 1]
        if mark == 0xD9:
            return p + 2
        n = struct.unpack_from(">H", b, p + 2)[0]
        if n < 2:
            return None
        p += 2 + n
        if mark == 0xDA:
            while True:
                p = b.find(b"\xff", p)
                if p < 0 or p + 1 >= len(b):
                    return None
                if b[p + 1] == 0 or 0xD0 <= b[p + 1] <= 0xD7:
                    p += 2
                else:
                    break
    return None


def _bmp(b: bytes, at: int) -> int | None:
    if at + 26 > len(b):
        return None
    size, _, start, head = struct.unpack_from("<IIII", b, at + 2)
    if head not in (12, 40, 52, 56, 64, 108, 124) or start < 14 + head or size < start or at + size > len(b):
        return None
    return at + size


def _gzip(b: bytes, at: int) -> int | None:
    if at + 18 > len(b) or b[at + 3] & 0xE0:
        return None
    z = zlib.decompressobj(31)
    try:
        left = memoryview(b)[at:]
        for i in range(0, len(left), 1 << 16):
            z.decompress(left[i : i + (1 << 16)])
            if z.eof:
                return at + min(len(left), i + (1 << 16)) - len(z.unused_data)
    except zlib.error:
        return None
    return None


def _pdf(b: bytes, at: int) -> int | None:
    if not b[at + 5 : at + 8].replace(b".", b"").isdigit():
        return None
    xref = b.find(b"startxref", at)
    end = b.find(b"%%EOF", xref) if xref >= 0 else -1
    return end + 5 if end >= 0 else None


def _zip(b: bytes, at: int) -> int | None:
    end = b.find(b"PK\x05\x06", at)
    while 0 <= end <= len(b) - 22:
        size, start, note = struct.unpack_from("<IIH", b, end + 12)
        if at + start + size == end and b[at + start : at + start + 4] in (b"PK\x01\x02", b"PK\x05\x06") and end + 22 + note <= len(b):
            return end + 22 + note
        end = b.find(b"PK\x05\x06", end + 4)
    return None


def _flac(b: bytes, at: int) -> int | None:
    p, first = at + 4, True
    while p + 4 <= len(b):
        kind, n = b[p] & 0x7F, int.from_bytes(b[p + 1 : p + 4], "big")
        if (first and (kind != 0 or n != 34)) or kind == 127 or p + 4 + n > len(b):
            return None
        last, first, p = b[p] & 0x80, False, p + 4 + n
        if last:
            return len(b)
    return None


#: Fixed values of the formats: magic bytes, media type and validator.
SIGNATURES = (
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"BM", "image/bmp", _bmp),
    (b"RIFF", "", _riff),
    (b"fLaC", "audio/flac", _flac),
    (b"%PDF-", "application/pdf", _pdf),
    (b"PK\x03\x04", "application/zip", _zip),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
)
_AUTOMATON = None


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick

        a = ahocorasick.Automaton()
        for i, (magic, _, _) in enumerate(SIGNATURES):
            a.add_word(magic.decode("latin-1"), i)
        a.make_automaton()
        _AUTOMATON = a
    return _AUTOMATON


def find_media(blob: bytes) -> list[tuple[str, int, int]]:
    """Confirmed media in a blob as ``(type, start, end)`` by start. A magic string whose structure fails is no hit."""
    found = []
    for last, i in _automaton().iter(blob.decode("latin-1")):
        magic, kind, valid = SIGNATURES[i]
        at = last - len(magic) + 1
        got = valid(blob, at)
        if got is not None:
            kind, end = got if isinstance(got, tuple) else (kind, got)
            found.append((kind, at, end))
    return sorted(found, key=lambda x: (x[1], -x[2], x[0]))


def sniff(blob: bytes, declared: str | None = None) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The type that the bytes prove (what starts at 0 and ends last, else the declared one) and the media embedded in the rest."""
    found = find_media(blob)
    outer = next((x for x in found if x[1] == 0), None)
    return (outer[0] if outer else declared), [x for x in found if x is not outer]


SNIFFED = "id {id}, declared string, actual string, corrected boolean, media array<struct<type:string,start:long,stop:long>>, carved array<binary>"


def sniff_media(df: DataFrame, id_col: str, blob_col: str, declared_col: str, carve: bool = True) -> DataFrame:
    """Sniffs a binary column: proven type, whether it corrects the declared one, embedded spans and, if asked for, their bytes.

    A null blob is empty: the declared type stands and nothing is embedded. Rows are independent; no shuffle.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = SNIFFED.format(id=kind)
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(blob_col), F.lit(b"")).alias("blob"), F.col(declared_col).cast("string").alias("declared"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            cols = {"actual": [], "corrected": [], "media": [], "carved": []}
            for blob, declared in zip(rb.column(1), rb.column(2), strict=True):
                blob, declared = blob.as_py(), declared.as_py()
                actual, inner = sniff(blob, declared)
                cols["actual"].append(actual)
                cols["corrected"].append(actual is not None and actual != declared)
                cols["media"].append([{"type": t, "start": s, "stop": e} for t, s, e in inner])
                cols["carved"].append([blob[s:e] for _, s, e in inner] if carve else [])
            media = pa.array(cols["media"], pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])))
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(2), pa.array(cols["actual"], pa.string()), pa.array(cols["corrected"], pa.bool_()), media, pa.array(cols["carved"], pa.list_(pa.binary()))], names=["id", "declared", "actual", "corrected", "media", "carved"])

    return src.mapInArrow(run, schema)


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """8-bit mono PCM: one sample a byte, so the payload is stored as it is."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload


def from_wav(blob: bytes) -> bytes:
    """The samples of the data chunk, found by walking the chunks of a sniffed file."""
    p = 12
    while p + 8 <= len(blob):
        name, n = struct.unpack_from("<4sI", blob, p)
        if name == b"data":
            return blob[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1)
    raise ValueError("no data chunk")


def encode_payload(text: str | None, unit: int = UNIT) -> tuple[int, bytes]:
    """UTF-8 bytes of the text (null: empty) and those bytes padded with spaces to a positive multiple of ``unit``."""
    raw = (text or "").encode()
    return len(raw), raw + b" " * (-len(raw) % unit if raw else unit)


def text_as_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: str = "application/octet-stream") -> DataFrame:
    """Each text stored as a WAV blob under a generic declared type: ``id, n_bytes, declared, blob``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo in range(0, rb.num_rows, 256):
                part = rb.slice(lo, 256)
                made = [encode_payload(t.as_py()) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([declared] * len(made), pa.string()), pa.array([to_wav(p) for _, p in made], pa.binary())], names=["id", "n_bytes", "declared", "blob"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, declared string, blob binary")


FEATURES = "id {id}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_features(blobs: DataFrame) -> DataFrame:
    """Reads stored blobs back: sniffs the type, decodes the samples of a proven WAV and describes both.

    ``feature``: proven type, samples, their rate, mean and number of distinct values, and each embedded medium with its span. A blob
    that is no WAV gives null payload values. Equal blobs give equal values.
    """
    kind = blobs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            out = [[] for _ in range(6)]
            for blob, declared in zip(rb.column(3), rb.column(2), strict=True):
                blob = blob.as_py()
                actual, inner = sniff(blob, declared.as_py())
                pay = from_wav(blob) if actual == "audio/wav" else None
                if pay is None:
                    values, what = (None, None, None), ""
                else:
                    values = (len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-TAIL:]))
                    what = f";samples={len(pay)};rate={struct.unpack_from('<I', blob, 24)[0]};mean={sum(pay) / max(1, len(pay)):.4f};distinct={len(set(pay))}"
                inside = ",".join(f"{t}@{s}+{e - s}" for t, s, e in inner)
                for col, v in zip(out, (*values, len(blob), hashlib.sha256(blob).hexdigest(), f"type={actual}{what};embedded={inside}"), strict=True):
                    col.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]], names=["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return blobs.select("id", "n_bytes", "declared", "blob").mapInArrow(run, FEATURES.format(id=kind))


def op4_signature_sniffing(spark, sf_dir: str) -> DataFrame:
    """All documents stored as samples, read back, sniffed and described."""
    out = media_features(text_as_media(table(spark, sf_dir, "documents")))
    return out.withColumnRenamed("id", "doc_id")

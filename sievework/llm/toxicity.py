"""Toxicity by a linear-chain conditional random field.

Tokens have two states, clean and toxic. Token features are the word and its first letters, kept where the labelled rows tie them to
toxicity beyond chance; tokens that carry one in a toxic document are the labelled tokens the field is fitted on. Forward-backward
gives each token's marginal; a document's score is a calibrated function of its marginals, its offending offsets are the tokens
whose marginal is high.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import Room, batches_of, table, text_or_empty, tidy

#: Labelled rows of each class that a model is fitted on at most: those whose hashed id is smallest.
SAMPLE_PER_CLASS = 4000
PREFIXES = (4, 5, 6)
STEM = 4
CONTEXT = 8
#: Features that are taken where fewer pass the bound on chance.
FEW = 20
THRESHOLD = 0.3
WORD = re.compile(r"[^\W_]+")


def lowered(text: str) -> str:
    """Lower case that keeps every offset."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def token_features(word: str) -> list[str]:
    return [f"={word}", *[word[:n] for n in PREFIXES if len(word) >= n]]


@dataclass
class ToxicModel:
    """Feature weights, state weights and the calibration of document scores."""

    weights: dict[str, float]
    bias: float
    step: tuple[tuple[float, float], tuple[float, float]]
    calibration: tuple[float, float, float]

    def __post_init__(self):
        self.stems = {f.lstrip("=")[:STEM] for f in self.weights}
        e = np.exp(np.array(self.step)) * np.array([1.0, math.exp(self.bias)])
        val, vec = np.linalg.eig(e)
        order = np.argsort(-val.real)
        val, vec = val.real[order], vec.real[:, order]
        inv = np.linalg.inv(vec)
        self.top, self.ratio = float(val[0]), float(val[1] / val[0])
        self.main = np.outer(vec[:, 0], inv[0])
        self.rest = np.outer(vec[:, 1], inv[1])
        self.base = e / self.top

    def _jump(self, gap: int) -> np.ndarray:
        """Transition over ``gap`` tokens without features and into the next state, without its emission, up to a scale."""
        if gap == 0:
            return np.exp(np.array(self.step))
        return (self.main + self.ratio**gap * self.rest) @ np.exp(np.array(self.step))

    def emission(self, word: str) -> float:
        if word[:STEM] not in self.stems:
            return 0.0
        w = self.weights
        return sum(w.get(f, 0.0) for f in token_features(word))

    def marginals(self, places: list[int], emissions: list[float], length: int) -> np.ndarray:
        """P(toxic) of the tokens at ``places`` of ``length``; tokens without features are summed out by matrix powers."""
        k = len(places)
        fwd, bwd = np.zeros((k, 2)), np.ones((k, 2))
        jumps = [self._jump(places[i] - places[i - 1] - 1) for i in range(1, k)]
        emit = np.exp(np.clip(np.stack([np.zeros(k), np.array(emissions) + self.bias], axis=1), -60, 60))
        head = np.array([1.0, 1.0]) if places[0] == 0 else np.array([1.0, math.exp(self.bias)]) @ (self.main + self.ratio ** (places[0] - 1) * self.rest) @ np.exp(np.array(self.step))
        fwd[0] = head * emit[0]
        fwd[0] /= fwd[0].sum()
        for i in range(1, k):
            fwd[i] = (fwd[i - 1] @ jumps[i - 1]) * emit[i]
            fwd[i] /= fwd[i].sum()
        after = length - 1 - places[-1]
        bwd[-1] = (self.main + self.ratio**after * self.rest) @ np.ones(2) if after else np.ones(2)
        bwd[-1] /= bwd[-1].sum()
        for i in range(k - 2, -1, -1):
            bwd[i] = jumps[i] @ (emit[i + 1] * bwd[i + 1])
            bwd[i] /= bwd[i].sum()
        both = fwd * bwd
        return both[:, 1] / both.sum(axis=1)

    def tag(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """Tokens with features as ``(start, stop, marginal)``, and the number of tokens."""
        stems, places, emissions, spans, n = self.stems, [], [], [], 0
        low = lowered(text)
        words = WORD.findall(low)
        n = len(words)
        hits = [i for i, w in enumerate(words) if w[:STEM] in stems]
        hits = [(i, e) for i in hits if (e := self.emission(words[i]))]
        if not hits:
            return [], n
        at = dict(hits)
        for i, m in enumerate(WORD.finditer(low)):
            if i in at:
                places.append(i)
                emissions.append(at[i])
                spans.append(m.span())
        p = self.marginals(places, emissions, n)
        return [(s, e, float(q)) for (s, e), q in zip(spans, p, strict=True)], n

    def score(self, marginals: list[float]) -> float:
        a, b, c = self.calibration
        x, y = _doc_features(marginals)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, a + b * x + c * y))))


def _doc_features(marginals: list[float]) -> tuple[float, float]:
    top = min(max(max(marginals, default=0.0), 1e-4), 1 - 1e-4)
    return math.log(top / (1 - top)), math.log1p(sum(marginals))


def feature_counts(texts: list[str], labels: list[int]) -> dict[str, list[int]]:
    """For each feature, how many of the texts that have it are clean and how many toxic."""
    out: dict[str, list[int]] = {}
    for text, y in zip(texts, labels, strict=True):
        for f in {f for w in set(WORD.findall(lowered(text))) for f in token_features(w)}:
            out.setdefault(f, [0, 0])[y] += 1
    return out


def least_count(toxic: int, clean: int) -> int:
    """In how many documents a feature must be for it to pass the bound at all."""
    base = toxic / (toxic + clean)
    return max(2, math.ceil(math.log(100) / math.log(1 / base)))


def lexicon(candidates: list[tuple[str, int, int]], tried: int, toxic: int, clean: int) -> list[str]:
    """Of ``(feature, toxic texts, clean texts)`` those that are toxic beyond chance (a Chernoff bound over all ``tried`` features that
    are frequent enough to pass it) and nearly always. Where fewer than ``FEW`` pass, as on small samples, the ``FEW`` with the most
    evidence are taken, of those that are toxic nearly always."""
    base, found = toxic / (toxic + clean), []
    for f, a, b in candidates:
        p = a / (a + b)
        if p > base and a + b >= 2 and a / toxic / (a / toxic + (b + 0.25) / clean) >= 0.9:
            kl = p * math.log(p / base) + ((1 - p) * math.log((1 - p) / (1 - base)) if p < 1 else 0.0)
            found.append(((a + b) * kl, f))
    need = math.log(max(tried, 2) / 0.5)
    found.sort(key=lambda x: (-x[0], x[1]))
    passed = sum(e > need for e, _ in found)
    return sorted(f for _, f in found[: max(passed, FEW)])


SPAN, WIDTH = 2 * CONTEXT + 1, len(PREFIXES) + 1


def text_windows(words: list[str], y: int, number: dict[str, int], spare: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows around the featured words of a whole text, or around one word (``spare`` picks it) where there are none.

    Feature numbers from 1 on, 0 for none (``SPAN * WIDTH`` a row), and for each token its state: toxic 1, clean 0, no token -1. A
    featured word inside the window before it has none of its own.
    """
    got = {k: f for k, w in enumerate(words) if (f := [number[x] for x in token_features(w) if x in number])}
    centres, stop = [], -1
    for k in sorted(got):
        if k > stop:
            centres.append(k)
            stop = k + CONTEXT
    if not centres and words:
        centres = [spare % len(words)]
    win, state = np.zeros((len(centres), SPAN, WIDTH), dtype=np.int32), np.full((len(centres), SPAN), -1, dtype=np.int8)
    for row, c in enumerate(centres):
        for t in range(SPAN):
            j = c - CONTEXT + t
            if 0 <= j < len(words):
                f = got.get(j, [])
                win[row, t, : len(f)] = f
                state[row, t] = int(bool(f) and y == 1)
    return win, state


def _fit_field(windows: np.ndarray, states: np.ndarray, often: np.ndarray, size: int, rounds: int = 150, l2: float = 1e-3) -> tuple[np.ndarray, float, np.ndarray]:
    """Maximum likelihood of the field on labelled windows by gradient steps with per-weight scaling.

    ``windows`` (rows, tokens, features): feature numbers, 0 for none. ``states``: labels, below 0 for no token. ``often``: how often
    each window occurs.
    """
    rows, span, _ = windows.shape
    mask, states, many = states >= 0, np.maximum(states, 0).astype(np.int64), often.astype(np.float64)[:, None]
    theta, bias, step = np.zeros(size + 1), -2.0, np.zeros((2, 2))
    seen = [np.zeros(size + 1), 0.0, np.zeros((2, 2))]
    total = max(1.0, float(often.sum()))
    for _ in range(rounds):
        emit = np.zeros((rows, span, 2))
        emit[:, :, 1] = np.where(mask, theta[windows].sum(axis=2) + bias, -60.0)
        pot, trans = np.exp(np.clip(emit, -60, 60)), np.exp(step)
        fwd, bwd = np.zeros((rows, span, 2)), np.ones((rows, span, 2))
        fwd[:, 0] = pot[:, 0] / pot[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, span):
            x = (fwd[:, t - 1] @ trans) * pot[:, t]
            fwd[:, t] = x / x.sum(axis=1, keepdims=True)
        for t in range(span - 2, -1, -1):
            x = (pot[:, t + 1] * bwd[:, t + 1]) @ trans.T
            bwd[:, t] = x / x.sum(axis=1, keepdims=True)
        gamma = fwd * bwd
        gamma /= gamma.sum(axis=2, keepdims=True)
        miss = np.where(mask, states - gamma[:, :, 1], 0.0) * many
        g_theta = np.bincount(windows.ravel(), weights=np.repeat(miss[:, :, None], windows.shape[2], axis=2).ravel(), minlength=size + 1) / total - l2 * theta
        g_theta[0] = 0.0
        g_bias = float(miss.sum()) / total
        xi = fwd[:, :-1, :, None] * trans * (pot[:, 1:] * bwd[:, 1:])[:, :, None, :]
        xi /= xi.sum(axis=(2, 3), keepdims=True)
        both = ((mask[:, :-1] & mask[:, 1:]) * many)[:, :, None, None]
        onehot = np.stack([1 - states, states], axis=2)
        truth = onehot[:, :-1, :, None] * onehot[:, 1:, None, :]
        g_step = ((truth - xi) * both).sum(axis=(0, 1)) / total - l2 * step
        for i, g in enumerate((g_theta, g_bias, g_step)):
            seen[i] = seen[i] + g * g
        theta = theta + 0.5 * g_theta / np.sqrt(seen[0] + 1e-8)
        bias = bias + 0.5 * g_bias / math.sqrt(seen[1] + 1e-8)
        step = step + 0.5 * g_step / np.sqrt(seen[2] + 1e-8)
    return theta, bias, step


def _field(features: list[str], win: np.ndarray, state: np.ndarray, often: np.ndarray) -> ToxicModel:
    theta, bias, step = _fit_field(win, state, often, len(features))
    return ToxicModel({f: float(theta[i + 1]) for i, f in enumerate(features)}, float(bias), tuple(map(tuple, step.tolist())), (0.0, 1.0, 1.0))


def _calibrated(model: ToxicModel, x: np.ndarray, y: np.ndarray, totals: dict[int, int] | None) -> ToxicModel:
    """Sets the calibration by a logistic fit on document features. Where the rows are a sample of each class, ``totals`` are the rows of
    all: rows are weighted by them, so scores do not depend on the sample's shares."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    share = np.ones(len(y))
    if totals:
        share = np.array([totals.get(v, 0) / max(1, int((y == v).sum())) for v in (0, 1)])[y]
        share = share / share.mean()
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (share * (y - p)) - np.array([0, 0.1, 0.1]) * w
        hess = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.1, 0.1])
        w = w + np.linalg.solve(hess, grad)
    model.calibration = tuple(float(v) for v in w)
    return model


NOTHING = ToxicModel({}, -4.0, ((0.0, 0.0), (0.0, 0.0)), (-4.0, 1.0, 0.0))


def fit(texts: list[str], labels: list[int], totals: dict[int, int] | None = None) -> ToxicModel:
    """A model from labelled texts that one process holds; ``fit_on`` does the same on tables. Without toxic or clean rows, or words, every
    score is that of a text without hits."""
    toxic, y = sum(labels), np.array(labels, dtype=np.int64)
    clean = len(labels) - toxic
    counts = [(f, a, b) for f, (b, a) in feature_counts(texts, labels).items()]
    if not toxic or not clean or not counts:
        return NOTHING
    features = lexicon(counts, sum(a + b >= least_count(toxic, clean) for _, a, b in counts), toxic, clean)
    number = {f: i + 1 for i, f in enumerate(features)}
    parts = [text_windows(WORD.findall(lowered(t)), v, number, i) for i, (t, v) in enumerate(zip(texts, labels, strict=True))]
    win, state = (np.concatenate(p) for p in zip(*parts, strict=True))
    model = _field(features, win, state, np.ones(len(win)))
    return _calibrated(model, np.array([_doc_features([p for _, _, p in model.tag(t)[0]]) for t in texts]), y, totals)


def held_out(id_col: str = "doc_id"):
    """Rows that no model is fitted on: CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> ToxicModel:
    """Fits on at most ``per_class`` labelled rows of each class outside the held-out quarter, the smallest by hashed id, by all windows of
    their whole texts.

    The bound is on labelled rows, whatever the input, so their ids may be broadcast. Texts stay on the executors: counts of features
    are combined there, and the driver gets the features that may pass, distinct windows with their numbers, and two numbers a row.
    Rows that share an id are one; null ids and labels are left out; a null text is empty.
    """
    spark = docs.sparkSession
    room = Room(spark)
    try:
        with batches_of(spark, 500):
            return _fit_on(docs, labels, id_col, text_col, per_class, room)
    finally:
        room.close()


def _fit_on(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_class: int, room: Room) -> ToxicModel:
    known = labels.where(~held_out(id_col) & F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(id_col).agg(F.max(F.col("toxic").cast("int")).alias("_y"))
    totals = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    order = [F.xxhash64(F.lit("toxicity"), id_col), F.col(id_col)]
    part = [known.where(F.col("_y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = part[0].unionByName(part[1])
    rows = docs.select(id_col, text_or_empty(text_col).alias("_text")).join(F.broadcast(chosen), id_col).groupBy(id_col).agg(F.min("_text").alias("text"), F.max("_y").alias("y"))
    rows = room.stored(rows.select("text", "y", F.abs(F.xxhash64(F.lit("spare"), id_col) % 1_000_003).alias("spare")), "toxic-sample")
    size = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return NOTHING

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for lo in range(0, rb.num_rows, 250):
                at = rb.slice(lo, 250)
                got = feature_counts(at.column("text").to_pylist(), at.column("y").to_pylist())
                pairs = list(got.values())
                yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array([p[1] for p in pairs], pa.int64()), pa.array([p[0] for p in pairs], pa.int64())], names=["f", "a", "b"])

    counts = rows.select("text", "y").mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    counts = room.stored(counts.where("a + b >= 2"), "toxic-counts")
    tried = counts.where(F.col("a") + F.col("b") >= least_count(toxic, clean)).count()
    likely = counts.where(F.col("a") * (F.col("b") + 0.25) > 0).where(F.col("a") / toxic >= 9 * (F.col("b") + 0.25) / clean * (1 - 1e-9))
    features = lexicon([(r["f"], r["a"], r["b"]) for r in likely.collect()], tried, toxic, clean)
    number = {f: i + 1 for i, f in enumerate(features)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            win, state = [], []
            for t, y, spare in zip(*[rb.column(c).to_pylist() for c in ("text", "y", "spare")], strict=True):
                w, s = text_windows(WORD.findall(lowered(t)), y, number, spare)
                win += [x.tobytes() for x in w]
                state += [x.tobytes() for x in s]
            yield pa.RecordBatch.from_arrays([pa.array(win, pa.binary()), pa.array(state, pa.binary())], names=["win", "state"])

    windows = rows.mapInArrow(cut, "win binary, state binary").groupBy("win", "state").count().orderBy("win", "state").collect()
    if not windows:
        return NOTHING
    win = np.frombuffer(b"".join([bytes(r["win"]) for r in windows]), dtype=np.int32).reshape(-1, SPAN, WIDTH)
    state = np.frombuffer(b"".join([bytes(r["state"]) for r in windows]), dtype=np.int8).reshape(-1, SPAN)
    model = _field(features, win, state, np.array([r["count"] for r in windows]))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            x = [_doc_features([p for _, _, p in model.tag(t)[0]]) for t in rb.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column("y"), *[pa.array([v[i] for v in x], pa.float64()) for i in (0, 1)]], names=["y", "u", "v"])

    got = sorted(rows.mapInArrow(measure, "y int, u double, v double").collect())
    return _calibrated(model, np.array([(r["u"], r["v"]) for r in got]), np.array([r["y"] for r in got], dtype=np.int64), totals)


def tag_toxic(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text", spans: bool = True, least: float = 0.5) -> DataFrame:
    """``id, score`` and the offending ``spans`` (code point offsets, marginal of at least ``least``) of every whole text.

    A null text is empty; a text without hits has the score of no evidence. Rows are independent; no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    struct = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rb in batches:
            scores, found = [], []
            for t in rb.column(1):
                hits, _ = model.tag(t.as_py())
                scores.append(model.score([p for _, _, p in hits]))
                found.append([{"start": s, "stop": e, "p": p} for s, e, p in hits if p >= least])
            cols = [rb.column(0), pa.array(scores, pa.float64())]
            if spans:
                cols.append(pa.array(found, pa.list_(struct)))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "score", "spans"][: len(cols)])
        tidy()

    schema = f"id {kind}, score double" + ", spans array<struct<start:long,stop:long,p:double>>" * spans
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def op5_crf_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every document by a field fitted on labelled rows outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    out = tag_toxic(docs, model).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), F.size("spans").alias("n_spans"))


def drop_toxic(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose whole text scores below the threshold."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rb in batches:
            keep = [model.score([p for _, _, p in model.tag(t.as_py() or "")[0]]) < threshold for t in rb.column(at)]
            yield rb.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams over two alphabets: bytes (n = 3, hashed)
and word shapes (n = 1 to 3). A shape says how a word is cased, whether it has
digits, what punctuation it carries, and whether it repeats the word before. Each
indicator is scaled by the log-ratio of its smoothed counts in the two classes,
and a linear model with hinge loss is fitted to the scaled indicators by dual
coordinate descent. A logistic map, fitted on a fifth of the training rows that
the linear model did not see, turns margins into probabilities.

Plan: the model is fitted on the driver from a bounded sample of labelled rows
(``SAMPLE``; their features are made on the executors, and texts over
``TRAIN_BYTES`` are left out of the sample). Every document is then scored in
one pass over its whole text, without an exchange; the model is a vector of
``FEATURES`` floats.

Defined results: null and empty texts have no n-grams and score the model's
intercept; repeated rows score alike; without labels of both classes every
document scores the share of label 1 (1/2 without any label); other columns
are not read (``score``) or are kept (``keep_good``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.labels import fold, label_sample, platt, sigmoid
from citeloom.llm.textvec import hash_spans, raw, slices, small_batches, word_spans

FEATURES = 1 << 16
#: Labelled rows of each class that are learned from, at most.
SAMPLE = 4_000
TRAIN_BYTES = 200_000
THRESHOLD = 0.3
_CHAR_BITS = 15
_SLICE_DOCS, _SLICE_BYTES = 64, 1_000_000

_UPPER, _LOWER, _DIGIT, _PUNCT, _HIGH = range(5)
_CLASS = np.full(256, _PUNCT, np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[0x80:] = _HIGH


def word_shapes(x: np.ndarray, starts: np.ndarray, lens: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """A number from 1 to 96 for each word."""
    if not len(starts):
        return np.zeros(0, np.int64)
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum())) - np.repeat(first, lens) + np.repeat(starts, lens)
    cls = _CLASS[x[at]]
    count = lambda c: np.add.reduceat((cls == c).astype(np.int32), first)
    upper, lower, digit, punct = count(_UPPER), count(_LOWER), count(_DIGIT), count(_PUNCT)
    case = np.where(upper == 0, 0, np.where(lower > 0, 1, np.where(upper > 1, 3, 2)))
    marks = np.minimum(punct, 3) + 1
    marks = np.where(punct == 0, 0, np.where(punct == lens, 5, marks))
    h = hash_spans(x, starts, lens)
    again = np.zeros(len(h), np.int64)
    again[1:] = h[1:] == h[:-1]
    opening = docs[:-1][docs[:-1] < len(h)]
    again[opening] = 0
    return 1 + case + 4 * (digit > 0) + 8 * again + 16 * marks


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, codes): codes are document * FEATURES + feature of rows [lo, hi), sorted and distinct."""
    for lo, hi in slices(texts, _SLICE_BYTES, _SLICE_DOCS):
        x, offs = raw(texts.slice(lo, hi - lo))
        flags = np.zeros((hi - lo) * FEATURES, bool)
        of = np.repeat(np.arange(hi - lo) * FEATURES, np.diff(offs))
        if len(x) > 2:
            v = x.astype(np.uint32)
            h = (v[:-2] * np.uint32(0x9E3779B1) ^ v[1:-1] * np.uint32(0x85EBCA77) ^ v[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
            inside = of[:-2] == of[2:]
            flags[(of[:-2] + (h >> np.uint32(32 - _CHAR_BITS)))[inside]] = True
        starts, lens, docs = word_spans(x, offs, x > 0x20)
        s = word_shapes(x, starts, lens, docs)
        if len(s):
            base = of[starts] + (1 << _CHAR_BITS)
            flags[base + s] = True
            two = (base[1:] == base[:-1]).nonzero()[0]
            flags[base[two] + 128 + s[two] * 97 + s[two + 1]] = True
            three = (base[2:] == base[:-2]).nonzero()[0]
            t = (s[three] * 97 + s[three + 1]) * 97 + s[three + 2]
            flags[base[three] + (1 << 14) + ((t * 0x9E3779B1) >> 12) % (1 << 14)] = True
        yield lo, hi, np.flatnonzero(flags)


@dataclass
class Model:
    weights: np.ndarray
    intercept: float
    scale: float
    shift: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for lo, hi, codes in features(texts):
            out[lo:hi] = np.bincount(codes >> 16, self.weights[codes & 0xFFFF], hi - lo)
        return sigmoid(self.scale * (out + self.intercept) + self.shift)


def dual_descent(rows: list[np.ndarray], r: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 30, seed: int = 3) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model on rows of indicator indices scaled by r; y is -1 or 1."""
    w, b = np.zeros(len(r)), 0.0
    alpha = np.zeros(len(rows))
    unit = [1 / max(1.0, np.sqrt(float((r[k] ** 2).sum()) + 1)) for k in rows]  # rows of unit length
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            k, u = rows[i], unit[i]
            g = y[i] * u * (float(w[k] @ r[k]) + b) - 1
            new = min(max(alpha[i] - g, 0.0), cost)
            d = new - alpha[i]
            if d:
                alpha[i] = new
                w[k] += d * y[i] * u * r[k]
                b += d * y[i] * u
                moved = max(moved, abs(d))
        if moved < 1e-3:
            break
    return w, b


def train(rows: list[np.ndarray], y: np.ndarray, smoothing: float = 1.0) -> Model:
    """The model of feature index rows and labels 0/1."""
    if not len(y) or y.min() == y.max():
        p = (float(y.sum()) + 1) / (len(y) + 2) if len(y) else 0.5
        return Model(np.zeros(FEATURES), 0.0, 1.0, float(np.log(p / (1 - p))))
    part = np.arange(len(y)) % 5 != 4
    if len({*y[part]}) < 2:
        part[:] = True
    fit = np.flatnonzero(part)
    count = lambda c: np.bincount(np.concatenate([rows[i] for i in fit if y[i] == c]), minlength=FEATURES) + smoothing
    pos, neg = count(1), count(0)
    r = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    w, b = dual_descent([rows[i] for i in fit], r, np.where(y[fit] == 1, 1.0, -1.0))
    weights = w * r
    rest = np.flatnonzero(~part)
    margin = np.array([float(weights[rows[i]].sum()) + b for i in rest])
    norm = float(np.abs(margin).mean()) if len(rest) else 1.0
    scale, shift = platt(margin / norm, y[rest]) if norm and len(rest) else (1.0, 0.0)
    return Model(weights, b, scale / (norm or 1.0), shift)


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, codes in features(b.column(1)):
            cut = np.searchsorted(codes, np.arange(hi - lo + 1) * FEATURES)
            rows = [(codes[i:j] & 0xFFFF).astype(np.uint16).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"_id": b.column(0).slice(lo, hi - lo), "_y": b.column(2).slice(lo, hi - lo), "_f": pa.array(rows, pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled rows of each class."""
    small_batches(docs)
    ids = label_sample(labels, label, {0: sample, 1: sample}, id_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where(F.octet_length("_text") <= TRAIN_BYTES)
    rows = rows.join(F.broadcast(ids), "_id").select("_id", "_text", "_y")
    got = rows.mapInArrow(_sampled, f"_id {rows.schema['_id'].dataType.simpleString()}, _y int, _f binary").toArrow()
    found = sorted({(i, y, bytes(f)) for i, y, f in zip(*(got.column(c).to_pylist() for c in ("_id", "_y", "_f")), strict=True)}, key=lambda x: (str(x[0]), x))
    return train([np.frombuffer(f, np.uint16).astype(np.int64) for _, _, f in found], np.array([y for _, y, _ in found], np.int64))


def _scored(model, text_at: int = 1):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"_id": b.column(0), "score": pa.array(model.value.score(b.column(text_at)))})

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score and predicted."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    out = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), f"_id {rows.schema['_id'].dataType.simpleString()}, score double")
    return out.select(F.col("_id").alias(id_col), (fold("_id") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _passing(model, text_at: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(model.value.score(b.column(text_at)) >= threshold))

    return run


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, that are not rejected."""
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    return docs.mapInArrow(_passing(docs.sparkSession.sparkContext.broadcast(model), at, threshold), docs.schema)

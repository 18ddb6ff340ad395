"""Toxicity classifier: a bidirectional gated recurrent network with attention pooling.

A word enters the network as its own vector (words of the training sample; any
other word is the zero vector) next to the mean of the vectors of its character
trigrams. Two recurrent layers read each window of ``WINDOW`` words forwards and
backwards, attention weighs the positions, and a linear unit scores the pooled
state. Windows overlap by half and cover the whole text; a document scores as its
most toxic window. The network is trained here in numpy by back-propagation
through time: of toxic documents the window that the network holds most toxic is
learned from (at first the one with the most telling word), of clean ones the most
toxic and a random one. A logistic map, fitted on a fifth of the sample that was
not trained on, turns scores into probabilities.

Plan: the driver trains on a bounded sample of labelled rows (``SAMPLE``, of texts
up to ``TRAIN_BYTES``), so its size does not depend on the corpus. Scoring is one
pass over all whole texts without an exchange; the input projections are made once
for the distinct words of a slice, and all windows of a slice run side by side.

Defined results: null, empty and wordless texts score the network's bias; repeated
rows score alike; without labels of both classes every document scores the share of
label 1 (1/2 without any label); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.labels import fold, label_sample, platt, sigmoid
from citeloom.llm.textvec import _WORD_LUT, hash_spans, raw, slices, word_spans

WINDOW, STRIDE = 48, 24
#: Labelled rows that are learned from, at most: clean, toxic.
SAMPLE = {0: 5_000, 1: 1_500}
TRAIN_BYTES = 16_000
WORD_DIM, CHAR_DIM, HIDDEN = 10, 6, 10
#: Share of the sample's texts that a word of the model's own must be in.
COMMON = 0.003
_CHARS = 4096
_IN = WORD_DIM + CHAR_DIM
_PAD = 0


class Words:
    """The distinct words of some texts: hashes, trigram codes, and each text's word numbers (from 1; 0 pads)."""

    def __init__(self, texts: pa.Array):
        data, offs = raw(texts)
        x = _WORD_LUT[data]
        starts, lens, self.docs = word_spans(x, offs, x != 0)
        h = hash_spans(x, starts, lens)
        self.hash, first, ids = np.unique(h, return_index=True, return_inverse=True)
        self.ids = ids.astype(np.int32) + 1
        lens = lens[first]
        self.cut = np.cumsum(lens) - lens
        at = np.arange(int(lens.sum())) - np.repeat(self.cut, lens) + np.repeat(starts[first], lens)
        own = x[at].astype(np.uint32)
        before, after = np.zeros(len(at), np.uint32), np.ones(len(at), np.uint32)
        before[1:], after[:-1] = own[:-1], own[1:]
        before[self.cut] = 0
        after[np.r_[self.cut[1:], len(at)] - 1 if len(self.cut) else []] = 1
        self.grams = ((before * np.uint32(0x9E3779B1) ^ own * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F) >> np.uint32(20)).astype(np.int32)
        self.lens = lens

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all overlapping windows, and the text of each."""
        n = np.diff(self.docs)
        count = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, 1)
        doc = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = np.maximum(np.minimum(k * STRIDE, n[doc] - WINDOW), 0)
        at = start[:, None] + np.arange(WINDOW)
        inside = at < n[doc][:, None]
        padded = np.r_[self.ids, np.int32(_PAD)]
        return np.where(inside, padded[np.minimum(at + self.docs[:-1][doc][:, None], len(padded) - 1)], _PAD), doc


class Network:
    def __init__(self, vocab: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.vocab = vocab  # sorted word hashes
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {
            "words": np.r_[np.zeros((1, WORD_DIM), np.float32), 0.1 * draw(max(1, len(vocab)), WORD_DIM) * np.sqrt(max(1, len(vocab)), dtype=np.float32)],
            "chars": (0.1 * rng.standard_normal((_CHARS, CHAR_DIM))).astype(np.float32),
            "attend": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "bias": np.full(1, -1.0, np.float32),
        }
        for side in "fb":
            self.p |= {f"x{side}": draw(_IN, 3 * HIDDEN), f"u{side}": draw(HIDDEN, 3 * HIDDEN), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.scale, self.shift = 1.0, 0.0
        self.constant: float | None = None

    def rows(self, words: Words) -> np.ndarray:
        """The row of each distinct word in the table of word vectors; 0 where it has none."""
        if not len(self.vocab):
            return np.zeros(len(words.hash), np.int64)
        at = np.minimum(np.searchsorted(self.vocab, words.hash), len(self.vocab) - 1)
        return np.where(self.vocab[at] == words.hash, at + 1, 0)

    def inputs(self, words: Words) -> np.ndarray:
        """Input vectors of padding and of each distinct word."""
        out = np.zeros((len(words.hash) + 1, _IN), np.float32)
        if len(words.hash):
            out[1:, :WORD_DIM] = self.p["words"][self.rows(words)]
            out[1:, WORD_DIM:] = np.add.reduceat(self.p["chars"][words.grams], words.cut, axis=0) / words.lens[:, None]
        return out

    def _run(self, side: str, gates: np.ndarray, idx: np.ndarray, keep: bool):
        """States of one direction, [T, B, H]; with keep also what the way back needs."""
        p, h, hid = self.p, np.zeros((len(idx), HIDDEN), np.float32), HIDDEN
        states, kept = np.empty((idx.shape[1], len(idx), hid), np.float32), []
        steps = range(idx.shape[1]) if side == "f" else range(idx.shape[1] - 1, -1, -1)
        for t in steps:
            x, g = gates[idx[:, t]], h @ p["u" + side]
            zr = 1 / (1 + np.exp(-(x[:, : 2 * hid] + g[:, : 2 * hid])))
            z, r = zr[:, :hid], zr[:, hid:]
            n = np.tanh(x[:, 2 * hid :] + r * g[:, 2 * hid :])
            if keep:
                kept.append((t, h, z, r, n, g[:, 2 * hid :]))
            h = n + z * (h - n)
            states[t] = h
        return states, kept

    def _pool(self, both: np.ndarray, mask: np.ndarray):
        a = np.where(mask, both @ self.p["attend"], np.float32(-1e9))
        a = np.exp(a - a.max(axis=0)) * mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        pooled = (a[:, :, None] * both).sum(axis=0)
        return a, pooled, pooled @ self.p["out"] + self.p["bias"][0]

    def logits(self, words: Words, idx: np.ndarray, chunk: int = 4096) -> np.ndarray:
        if not len(idx):
            return np.zeros(0, np.float32)
        x = self.inputs(words)
        gates = {s: x @ self.p["x" + s] + self.p["c" + s] for s in "fb"}
        out = np.empty(len(idx), np.float32)
        for i in range(0, len(idx), chunk):
            part = idx[i : i + chunk]
            both = np.concatenate([self._run(s, gates[s], part, False)[0] for s in "fb"], axis=2)
            out[i : i + chunk] = self._pool(both, part.T != _PAD)[2]
        return out

    def doc_logits(self, texts: pa.Array) -> np.ndarray:
        """The highest window score of each text."""
        out = np.empty(len(texts), np.float32)
        for lo, hi in slices(texts):
            words = Words(texts.slice(lo, hi - lo))
            idx, doc = words.windows()
            out[lo:hi] = np.maximum.reduceat(self.logits(words, idx), np.searchsorted(doc, np.arange(hi - lo)))
        return out

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return sigmoid(self.scale * self.doc_logits(texts).astype(np.float64) + self.shift)

    def gradients(self, words: Words, rows: np.ndarray, idx: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted logistic loss over some windows; for word vectors by row number."""
        p, hid = self.p, HIDDEN
        x = self.inputs(words)
        gates = {s: x @ p["x" + s] + p["c" + s] for s in "fb"}
        ran = {s: self._run(s, gates[s], idx, True) for s in "fb"}
        both = np.concatenate([ran[s][0] for s in "fb"], axis=2)
        mask = idx.T != _PAD
        a, pooled, logit = self._pool(both, mask)
        d = ((sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        g = {"bias": np.array([d.sum()], np.float32), "out": pooled.T @ d}
        dpool = d[:, None] * p["out"]
        da = (both * dpool).sum(axis=2)
        ds = a * (da - (a * da).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", ds, both)
        dboth = a[:, :, None] * dpool + ds[:, :, None] * p["attend"]
        dx = np.zeros_like(x)
        for k, s in enumerate("fb"):
            dstate, dh = dboth[:, :, k * hid : (k + 1) * hid], np.zeros((len(idx), hid), np.float32)
            du, dgates = np.zeros_like(p["u" + s]), np.zeros_like(gates[s])
            for t, h, z, r, n, gn in reversed(ran[s][1]):
                dh = dh + dstate[t]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * gn * r * (1 - r)
                dg = np.concatenate([dz, dr, dn * r], axis=1)
                np.add.at(dgates, idx[:, t], np.concatenate([dz, dr, dn], axis=1))
                du += h.T @ dg
                dh = dh * z + dg @ p["u" + s].T
            g["u" + s], g["c" + s], g["x" + s] = du, dgates.sum(axis=0), x.T @ dgates
            dx += dgates @ p["x" + s].T
        g["words"] = np.zeros_like(p["words"])
        np.add.at(g["words"], rows, dx[1:, :WORD_DIM])
        g["words"][0] = 0
        g["chars"] = np.zeros_like(p["chars"])
        np.add.at(g["chars"], words.grams, np.repeat(dx[1:, WORD_DIM:] / words.lens[:, None], words.lens, axis=0))
        return g


class Adam:
    def __init__(self, p: dict, rate: float = 0.01):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((x * x).sum()) for x in g.values())))
        for k, x in g.items():
            x = x * min(1.0, 5 / max(norm, 1e-9))
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.01 * (x * x - self.v[k])
            if k in ("chars", "words"):
                self.p[k] *= np.float32(1 - self.rate * 0.1)
            self.p[k] -= (self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-7)).astype(np.float32)


class _Some(Words):
    """The distinct words of some windows only."""

    def __init__(self, words: Words, idx: np.ndarray):
        used = np.unique(idx[idx != _PAD]) - 1
        self.hash, self.lens = words.hash[used], words.lens[used]
        self.cut = np.cumsum(self.lens) - self.lens
        self.grams = words.grams[np.arange(int(self.lens.sum())) - np.repeat(self.cut, self.lens) + np.repeat(words.cut[used], self.lens)]
        to = np.zeros(len(words.hash) + 1, np.int32)
        to[used + 1] = np.arange(1, len(used) + 1)
        self.idx = to[idx]


def train(texts: pa.Array, y: np.ndarray, rounds: int = 6, batch: int = 128, least_steps: int = 300, seed: int = 5) -> Network:
    """Fit on texts and labels 0/1."""
    rng = np.random.default_rng(seed)
    words = Words(texts)
    of_word = np.repeat(np.arange(len(y)), np.diff(words.docs))
    seen = np.unique(of_word * np.int64(len(words.hash) + 1) + words.ids)
    doc, word = seen // (len(words.hash) + 1), seen % (len(words.hash) + 1)
    df = np.bincount(word, minlength=len(words.hash) + 1)
    net = Network(words.hash[df[1:] >= max(3, len(y) * COMMON)])
    if not len(y) or y.min() == y.max():
        net.constant = (float(y.sum()) + 1) / (len(y) + 2) if len(y) else 0.5
        return net
    idx, of = words.windows()
    fit = np.arange(len(y)) % 5 != 4
    if len({*y[fit]}) < 2 or len({*y[~fit]}) < 2:
        fit[:] = True
    hot = np.bincount(word, y[doc] * fit[doc], len(df))
    told = np.log((hot + 3) / (fit & (y == 1)).sum()) - np.log((np.bincount(word, fit[doc], len(df)) - hot + 3) / (fit & (y == 0)).sum())
    told[_PAD] = -9
    lead = told[idx].max(axis=1)
    adam, first = Adam(net.p), np.searchsorted(of, np.arange(len(y)))
    count = np.diff(np.r_[first, len(of)])
    share = float(y[fit].mean())
    batch = min(batch, max(16, int(fit.sum()) // 20))
    rounds = max(rounds, min(20, -(-least_steps * batch // int(2 * fit.sum()))))
    for turn in range(rounds):
        if turn:
            lead = net.logits(words, idx)
        order = np.lexsort((-lead, of))
        top, second = order[first], order[np.minimum(first + 1, first + count - 1)]
        trust = np.where((y == 1) & (lead[top] < (0 if turn else 2)), 0.05, 1.0)
        more = first + (rng.random(len(y)) * count).astype(np.int64)
        pick = np.r_[top[fit], second[fit & (y == 0) & (count > 1)], more[fit & (y == 0) & (count > 2)]]
        rng.shuffle(pick)
        adam.rate = 0.01 * (1 - 0.8 * turn / rounds)
        for i in range(0, len(pick), batch):
            own = pick[i : i + batch]
            some = _Some(words, idx[own])
            target = y[of[own]].astype(np.float32)
            adam.step(net.gradients(some, net.rows(some), some.idx, target, trust[of[own]] * np.where(target == 1, 0.5 / share, 0.5 / (1 - share))))
    best = np.maximum.reduceat(net.logits(words, idx), first).astype(np.float64)
    held = ~fit if (~fit).any() else fit
    net.scale, net.shift = platt(best[held], y[held])
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: dict[int, int] | None = None) -> Network:
    """Train on at most ``sample[y]`` labelled rows of each label y."""
    ids = label_sample(labels, label, sample or SAMPLE, id_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).where(F.octet_length("_text") <= TRAIN_BYTES)
    got = rows.join(F.broadcast(ids), "_id").select("_id", "_text", "_y").toArrow()
    found = sorted({*zip(*(got.column(c).to_pylist() for c in ("_id", "_text", "_y")), strict=True)}, key=lambda x: (str(x[0]), x[1]))
    mixed = np.random.default_rng(1).permutation(len(found))
    return train(pa.array([found[i][1] for i in mixed], pa.string()), np.array([found[i][2] for i in mixed], np.int64))


def _scored(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"_id": b.column(0), "score": pa.array(model.value.score(b.column(1)))})

    return run


def score(docs: DataFrame, model: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: id, held_out, score and predicted."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    out = rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(model)), f"_id {rows.schema['_id'].dataType.simpleString()}, score double")
    return out.select(F.col("_id").alias(id_col), (fold("_id") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

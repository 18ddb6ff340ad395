"""Secret scan: pattern findings, and a character network over every candidate.

Base findings come from three patterns (assign, access, hex). Candidates are all
maximal runs of token characters, of any length. A run over ``SPAN`` characters
is read in windows of that length, ``STEP`` apart, the last one at its end; its
score is the highest of theirs. A convolutional network over characters reads each
candidate with ``SIDE`` characters before and after it: characters are looked up in a
table of vectors, filters of two widths slide over the text, the maximum over positions
of each filter is taken for candidate and context apart, and a dense layer scores
them. It is trained in numpy by back-propagation on labelled findings: windows that
hold the value of a base finding, or half a window of it, are secrets; those that only
touch a base finding are left out; all others are not secrets. The key words of the
assign pattern are blotted out in what it learns from, so that it learns the look of
values and not the pattern over again. Scores are made probabilities by a logistic map,
the threshold is the highest at which at least ``RECALL`` of the secrets it is set from
are found. Candidates over the threshold that no base finding overlaps are added as
spans of kind "model"; base findings always stay.

Every labelled window of every document has its part in the model. Texts are dealt by
hash to ``PARTS`` parts. An eighth of the parts each is held back to measure (``report``
has precision and recall there) and to calibrate: the logistic map and the threshold
come from counts of all windows by class and score, in steps of 1 / ``BINS``. Each other
part makes one step of the training: the gradient of the loss is summed over all its
windows. The loss is the logistic one less its value at ``MARGIN`` and 0 beyond, so that
windows told by that much add exactly nothing to the gradient. Where the training starts
is found on the driver, from at most ``SAMPLE`` windows of each class (secrets of all
documents, long runs with a digit, other runs).

Plan: every text is scored twice (with its part, and in the scan), without an exchange
of texts; gradients are exchanged as sums, in whole numbers, so that they do not
depend on how rows are dealt to tasks. A filter's value at a position does not depend on
the candidate, so it is computed once per character, from tables of what characters and
pairs of them add to it, and candidates only take maxima. Neighbouring short texts are
read together, with pads between them, and windows with a loss of many texts go through
one back-propagation; neither changes a bit of a score or a gradient.

Defined results: null and empty texts have no findings; repeated rows are each
learned from and scanned; without candidates of both classes nothing is added; where
the parts held back or the others lack a class, all parts train, calibrate and nothing
is measured; texts of any length are read whole; other columns are not read. Offsets
are code points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.labels import platt, sigmoid
from citeloom.staging import staged

# The base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "model")
KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")  # no assign finding without one
DIGITS = bytes(48 if chr(i) in "0123456789abcdef" else 32 for i in range(256))

TOKEN = np.zeros(128, bool)
TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_TOKEN = bytes(TOKEN) + bytes(128)
SPAN, SIDE, STEP = 48, 24, 12
STRETCH = 8_000  # characters whose filter values are held at once, of one text or of several short ones
ROWS = 48  # windows in a matrix product
BLOT = ord("x")
LONG = 16  # from here on a run with a digit is of the second class of the start
SAMPLE = 3_000
RECALL = 0.98
PARTS, HELD = 16, 2  # the first HELD parts measure, the next HELD calibrate
MARGIN = 4.0
BINS, TOP = 256, 64  # scores are counted between -TOP and TOP
UNIT = 2.0**24  # gradients are summed in whole numbers of 1 / UNIT
GROUP = 1_024  # windows whose gradient is taken at once
DIM, FILTERS, WIDTHS, DENSE = 8, 16, (3, 5), 16

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind that are long enough, by start, then kind."""
    found = []
    plain = text.encode("utf-8", "surrogatepass")
    low = plain.lower() if ":" in text or "=" in text else b""
    if any(k in low for k in KEYS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"0" * 24 in plain.translate(DIGITS):
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def codes_of(text: str) -> np.ndarray:
    """One byte a code point, non-ASCII is 1."""
    if text.isascii():
        return np.frombuffer(text.encode("ascii"), np.uint8).copy()
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = c.astype(np.uint8)
    np.putmask(out, c > 127, 1)
    return out


def candidates(codes: np.ndarray, base: list[Span]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, and whether a base finding overlaps it, of every maximal run."""
    own = np.frombuffer(b"\0" + codes.tobytes().translate(_TOKEN) + b"\0", bool)
    edge = np.flatnonzero(own[1:] != own[:-1])
    a, b = edge[::2].copy(), edge[1::2].copy()
    known = np.zeros(len(a), bool)
    for _, x, y in base:
        known[np.searchsorted(b, x, "right") : np.searchsorted(a, y, "left")] = True
    return a, b, known


def windows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Run, start and end of the windows that read the runs; a run up to ``SPAN`` is one."""
    if not len(a) or (b - a).max() <= SPAN:
        return np.arange(len(a)), a, b
    more = np.maximum(0, -(-(b - a - SPAN) // STEP))
    run = np.repeat(np.arange(len(a)), more + 1)
    nth = np.arange(len(run)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    start = np.minimum(a[run] + nth * STEP, np.maximum(a, b - SPAN)[run])
    return run, start, np.minimum(start + SPAN, b[run])


def labels_of(text: str, base: list[Span], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """1 for windows of secrets, -1 for those that only touch a base finding, 0 for others."""
    y = np.zeros(len(start), np.int64)
    if not base:
        return y
    near = lambda p, q: slice(np.searchsorted(end, p, "right"), np.searchsorted(start, q, "left"))
    for _, p, q in base:
        y[near(p, q)] = -1
    for kind, p, q in base:
        if kind == "assign":
            p = ASSIGN.match(text, p).start(2)
        at = near(p, q)
        y[at][np.minimum(end[at], q) - np.maximum(start[at], p) >= min(q - p, SPAN // 2)] = 1
    return y


def encoded(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Many windows of one text with the characters around them, a row of bytes each; 0 pads, the last byte is the window's length."""
    c = np.concatenate([np.zeros(_EDGE, np.uint8), codes, np.zeros(SPAN + _EDGE, np.uint8)])
    out = np.empty((len(start), _LEN + 1), np.uint8)
    out[:, :_LEN] = np.where(np.arange(_LEN) < (end - start)[:, None] + 2 * _EDGE, c[start[:, None] + np.arange(_LEN)], 0)
    out[:, _LEN] = end - start
    return out


_REACH = 2  # characters that the widest filter sees to each side
_EDGE = SIDE + _REACH
_LEN = _EDGE + SPAN + _EDGE
_GAP = "\0" * _EDGE
_LEVEL = np.array([min(4, max(1, n).bit_length() - 1) for n in range(SPAN + 1)])


def together(texts: list[str]) -> Iterator[slice]:
    """Which neighbouring texts are read together; a text of ``STRETCH`` characters or more is read alone."""
    i = size = 0
    for j, text in enumerate(texts):
        if j > i and size + len(text) > STRETCH:
            yield slice(i, j)
            i, size = j, 0
        size += len(text) + _EDGE
    if i < len(texts):
        yield slice(i, len(texts))


def joint(texts: list[str], bases: list[list[Span]]) -> tuple[np.ndarray, np.ndarray, list[Span]]:
    """Codes of texts one after the other, with as many 0 between them as a window reads beside it, where each text starts, and the findings there."""
    first = np.cumsum([0, *(len(t) + _EDGE for t in texts[:-1])])
    return codes_of(_GAP.join(texts)), first, [(k, p + o, q + o) for o, base in zip(first.tolist(), bases, strict=True) for k, p, q in base]


class Network:
    def __init__(self, seed: int = 9):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(np.prod(s[:-1]))).astype(np.float32)
        self.p = {"chars": (0.3 * rng.standard_normal((128, DIM))).astype(np.float32)}
        for w in WIDTHS:
            self.p |= {f"f{w}": draw(w, DIM, FILTERS), f"b{w}": np.zeros(FILTERS, np.float32)}
        pooled = 2 * len(WIDTHS) * FILTERS
        self.p |= {"dense": draw(pooled, DENSE), "db": np.zeros(DENSE, np.float32), "out": draw(DENSE, 1)[:, 0], "ob": np.zeros(1, np.float32)}
        self.scale, self.shift, self.threshold = 1.0, 0.0, 2.0
        self.report: dict[str, float] = {}
        self.made = None  # the tables of the trained weights; each worker makes its own
        self.room = np.empty(0, np.float32)  # for filter values, kept from call to call

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": None, "room": np.empty(0, np.float32)}

    def forward(self, x: np.ndarray, keep: bool = False):
        """Scores of encoded windows [B, L + 1]."""
        p, size = self.p, x[:, _LEN, None]
        at = np.arange(SIDE + SPAN + SIDE)[None]  # positions with a whole filter around them
        own = (at >= SIDE) & (at < SIDE + size)
        around = (at < SIDE) | ((at >= SIDE + size) & (at < 2 * SIDE + size))
        e = p["chars"][x[:, :_LEN]]
        pooled, kept = [], []
        for w in WIDTHS:
            first = _REACH - w // 2
            c = sum(e[:, first + j : first + j + at.shape[1]] @ p[f"f{w}"][j] for j in range(w)) + p[f"b{w}"]
            for side in (own, around):
                part = np.where(side[:, :, None], c, np.float32(-1e9))
                best = part.argmax(axis=1)
                top = np.take_along_axis(part, best[:, None, :], 1)[:, 0]
                pooled.append(np.maximum(top, 0))
                kept.append((w, best + first, top > 0))
        h = np.concatenate(pooled, axis=1)
        a = np.maximum((h[:, None] @ p["dense"])[:, 0] + p["db"], 0)  # a row at a time: its bits do not depend on the others
        y = (a * p["out"]).sum(axis=1) + p["ob"][0]
        return (y, (e, kept, h, a)) if keep else y

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Of the mean of the weighted logistic losses."""
        p = self.p
        score, (e, kept, h, a) = self.forward(x, True)
        d = ((sigmoid(score) - y) * weight / len(y)).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["ob"][0], g["out"] = d.sum(), a.T @ d
        da = d[:, None] * p["out"] * (a > 0)
        g["dense"], g["db"] = h.T @ da, da.sum(axis=0)
        dh, de, rows = da @ p["dense"].T, np.zeros_like(e), np.arange(len(x))[:, None]
        for i, (w, at, live) in enumerate(kept):
            dc = dh[:, i * FILTERS : (i + 1) * FILTERS] * live
            g[f"b{w}"] += dc.sum(axis=0)
            for j in range(w):
                g[f"f{w}"][j] += np.einsum("bfd,bf->df", e[rows, at + j], dc)
                np.add.at(de, (rows, at + j), dc[:, :, None] * p[f"f{w}"][j].T[None])
        np.add.at(g["chars"], x[:, :_LEN], de)
        return g

    def units(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """``gradients`` of the sum of the logistic losses in units, in one row; every product is rounded, so that it does not matter which windows are taken together."""
        p = self.p
        score, (e, kept, h, a) = self.forward(x, True)
        d = (sigmoid(score) - y).astype(np.float32)
        whole = lambda v: np.rint(v * np.float32(UNIT))
        total = lambda v: whole(v).sum(axis=0, dtype=np.float64)
        g = {k: np.zeros(v.shape) for k, v in p.items()}
        g["ob"][0], g["out"] = total(d), total(d[:, None] * a)
        da = d[:, None] * p["out"] * (a > 0)
        g["dense"], g["db"] = total(h[:, :, None] * da[:, None]), total(da)
        dh, rows = (da[:, None] @ p["dense"].T)[:, 0], np.arange(len(x))[:, None]
        chars, dims = np.zeros(g["chars"].size), np.arange(DIM)
        for i, (w, at, live) in enumerate(kept):
            dc = dh[:, i * FILTERS : (i + 1) * FILTERS] * live
            g[f"b{w}"] += total(dc)
            b, f = np.nonzero(dc)
            for j in range(w):
                g[f"f{w}"][j] += total(e[rows, at + j] * dc[:, :, None]).T
                to = x[b, at[b, f] + j][:, None] * DIM + dims
                chars += np.bincount(to.ravel(), whole(dc[b, f, None] * p[f"f{w}"][j].T[f]).ravel(), len(chars))
        g["chars"] = chars
        return np.concatenate([g[k].ravel() for k in p]).astype(np.int64)

    def tables(self) -> tuple:
        """What the first character, and the pairs of the second and third and of the last two, add to the filters of widths 3 and 5; the dense layer of the window and of what is around it."""
        (a, b, c), five = ([(self.p["chars"] @ f).astype(np.float32) for f in self.p[f"f{w}"]] for w in WIDTHS)
        both = lambda *x: np.concatenate(x, axis=1)
        pairs = lambda x, y: (x[:, None] + y[None]).reshape(-1, x.shape[1])
        none = np.zeros_like(c)
        dense = self.p["dense"].reshape(len(WIDTHS), 2, FILTERS, DENSE)
        return (
            both(none, five[0] + self.p["b5"]),
            pairs(both(a, five[1]), both(b, five[2])),
            pairs(both(c + self.p["b3"], five[3]), both(none, five[4])),
            *(np.ascontiguousarray(dense[:, i].reshape(-1, DENSE)) for i in range(2)),
        )

    def scores(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray | None) -> np.ndarray:
        """``forward`` of windows of a stretch of text that has at least ``_EDGE`` characters (0 pads) on both sides of each."""
        # The bits of a product depend on its shape and on the place of a row in it: each text has blocks of its own, so its scores do not depend on others.
        n = np.array([len(start)]) if of is None else np.bincount(of)
        blocks = -(-n // ROWS) * ROWS
        place = np.arange(len(start)) + np.repeat(np.cumsum(blocks) - blocks - np.cumsum(n) + n, n)
        filled = np.zeros(blocks.sum(), np.intp)
        filled[place] = np.arange(len(start))
        start, end = start[filled], end[filled]
        if self.made is None:
            self.made = self.tables()
        first, second, last, inner, outer = self.made
        z = codes.astype(np.intp)
        pair, n = z[:-1] * 128 + z[1:], len(z) - 2 * _REACH
        m, wide = len(start), first.shape[1]
        if len(self.room) < (5 * n + 3 * m) * wide:
            self.room = np.empty((5 * n + 3 * m) * wide, np.float32)
        most = self.room[: 5 * n * wide].reshape(5, n, wide)  # row p of the i-th has the maximum over 2**i positions from p
        own, around, other = self.room[5 * n * wide : (5 * n + 3 * m) * wide].reshape(3, m, wide)
        second.take(pair[1 : 1 + n], axis=0, out=most[0], mode="clip")
        for table, at in ((last, pair[3 : 3 + n]), (first, z[:n])):
            table.take(at, axis=0, out=most[1], mode="clip")
            most[0] += most[1]
        np.maximum(most[0], np.float32(0), out=most[0])
        for i in range(4):
            left = n + 1 - (2 << i)
            np.maximum(most[i, :left], most[i, 1 << i : (1 << i) + left], out=most[i + 1, :left])
        flat, a, b = most.reshape(5 * n, wide), start - _REACH, end - _REACH

        def highest(into: np.ndarray, *rows: np.ndarray) -> None:
            flat.take(rows[0], axis=0, out=into, mode="clip")
            for at in rows[1:]:
                flat.take(at, axis=0, out=other, mode="clip")
                np.maximum(into, other, out=into)

        level = _LEVEL[b - a]  # two or three rows make a window's
        base = level * n
        highest(own, base + a, base + b - (1 << level))
        long = np.flatnonzero(b - a > 32)
        if len(long):
            own[long] = np.maximum(own[long], most[4, a[long] + 16])
        left, right = a + (4 * n - SIDE), b + 4 * n
        highest(around, left, left + (SIDE - 16), right, right + (SIDE - 16))
        h = own.reshape(-1, ROWS, wide) @ inner
        h += around.reshape(-1, ROWS, wide) @ outer
        h += self.p["db"]
        np.maximum(h, np.float32(0), out=h)
        return (h @ self.p["out"]).ravel()[place] + self.p["ob"][0]

    def margins(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """``forward`` of windows of one text, ordered by start, or of texts read together, where ``of`` says which each is of."""
        y, c = np.zeros(len(start)), np.concatenate([np.zeros(_EDGE, np.uint8), codes, np.zeros(_EDGE, np.uint8)])
        i = 0
        while i < len(start):
            j = max(i + 1, int(np.searchsorted(start, start[i] + STRETCH)))
            lo, hi = start[i], int(end[i:j].max()) + 2 * _EDGE
            y[i:j] = self.scores(c[lo:hi], start[i:j] - lo + _EDGE, end[i:j] - lo + _EDGE, None if of is None else of[i:j] - of[i])
            i = j
        return y

    def probability(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray | None = None) -> np.ndarray:
        """Of the windows of ``margins``."""
        return sigmoid(self.scale * self.margins(codes, start, end, of) + self.shift)


def matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, _LEN + 1).astype(np.int64) & 127


def _adam(net: Network, rate: float):
    """A function that moves the weights against a gradient."""
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    t = 0

    def move(gradients: dict) -> None:
        nonlocal t
        t += 1
        for k, g in gradients.items():
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            net.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        net.made = None

    return move


def started(rows: list[bytes], y: np.ndarray, rounds: int = 8, batch: int = 64, rate: float = 0.005, seed: int = 4) -> Network:
    """A network fitted to encoded windows of both classes, which weigh the same."""
    net = Network()
    x, rng, share = matrix(rows), np.random.default_rng(seed), float(y.mean())
    move = _adam(net, rate)
    for _ in range(max(rounds, min(40, 120 * batch // len(y)))):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            move(net.gradients(x[own], y[own], np.where(y[own] == 1, 0.5 / max(share, 1e-3), 0.5 / max(1 - share, 1e-3))))
    return net


_MIX = np.random.default_rng(7).integers(0, 2**63, _LEN + 1, np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(x: np.ndarray) -> np.ndarray:
    h = x.astype(np.uint64) @ _MIX
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def _learned(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Joint codes with the key words blotted out, start, end and label of all windows that have one, and which text each is of."""
    bases = [base_spans(t) for t in texts]
    codes, first, spans = joint(texts, bases)
    _, start, end = windows(*candidates(codes, [])[:2])
    y, of = np.zeros(len(start), np.int64), np.searchsorted(first, start, "right") - 1
    if not spans:
        return codes, start, end, y, of
    for i, (text, base, o) in enumerate(zip(texts, bases, first.tolist(), strict=True)):
        if base:
            own = slice(*np.searchsorted(of, [i, i + 1]))
            y[own] = labels_of(text, base, start[own] - o, end[own] - o)
        for kind, p, _ in base:
            if kind == "assign":
                codes[o + p : o + ASSIGN.match(text, p).end(1)] = BLOT
    own = y >= 0
    return codes, start[own], end[own], y[own], of[own]


def _starting(sample: int):
    """Of each class the ``sample`` different windows of lowest hash in a partition; of texts not chosen, in those with a base finding."""

    def least(h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h, at = np.unique(h, return_index=True)
        return h[:sample], x[at[:sample]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {k: (np.zeros(0, np.int64), np.zeros((0, _LEN + 1), np.uint8)) for k in range(3)}
        for batch in batches:
            texts = [t for t, chosen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if chosen or base_spans(t)]
            for group in together(texts):
                codes, start, end, y, _ = _learned(texts[group])
                digits = np.concatenate([[0], np.cumsum((codes >= 48) & (codes <= 57))])
                hard = (end - start >= LONG) & (digits[end] > digits[start])
                for i in range(0, len(start), 65_536):
                    part = slice(i, i + 65_536)
                    x = encoded(codes, start[part], end[part])
                    h = _hashes(x)
                    for k, own in enumerate(((y == 1)[part], ((y == 0) & hard)[part], ((y == 0) & ~hard)[part])):
                        if len(best[k][0]) == sample:
                            own = own & (h < best[k][0][-1])
                        if own.any():
                            best[k] = least(np.concatenate([best[k][0], h[own]]), np.concatenate([best[k][1], x[own]]))
        for k, (h, x) in best.items():
            yield pa.RecordBatch.from_pydict({"_h": pa.array(h, pa.int64()), "_x": pa.array([r.tobytes() for r in x], pa.binary()), "_k": pa.array([k] * len(h), pa.int32())})

    return run


def _missed(texts: list[str], net: Network) -> tuple[int, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """How many windows of texts there are, and those that have a loss with their labels, at most ``GROUP`` at a time."""
    codes, start, end, y, of = _learned(texts)
    miss = np.flatnonzero(np.where(y == 1, 1, -1) * net.margins(codes, start, end, of) < MARGIN)

    def groups() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(miss), GROUP):
            own = miss[i : i + GROUP]
            lo = max(0, int(start[own[0]]) - _EDGE)
            yield encoded(codes[lo : int(end[own].max()) + _EDGE], start[own] - lo, end[own] - lo), y[own]

    return len(y), groups()


def text_gradient(text: str, net: Network) -> tuple[np.ndarray | None, int, int]:
    """The gradient of the sum of the losses of all windows of a text in units, how many have a loss, and how many there are."""
    every, groups = _missed([text], net)
    total, miss = None, 0
    for x, y in groups:
        units = net.units(x.astype(np.int64), y)
        total, miss = units if total is None else total + units, miss + len(y)
    return total, miss, every


def _gradient(model):
    """The sums over all texts of a partition by number of the weight; -1 counts windows with a loss, -2 all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        total, miss, every, held = np.zeros(sum(v.size for v in net.p.values()), np.int64), 0, 0, []

        def take() -> None:
            nonlocal total, miss
            total += net.units(np.concatenate([x for x, _ in held]).astype(np.int64), np.concatenate([y for _, y in held]))
            miss += sum(len(y) for _, y in held)
            held.clear()

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for group in together(texts):
                n, some = _missed(texts[group], net)
                every += n
                for missed in some:
                    held.append(missed)
                    if sum(len(y) for _, y in held) >= GROUP:
                        take()
        if held:
            take()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"_k": pa.array([-2, -1, *at.tolist()], pa.int32()), "_n": pa.array([every, miss, *total[at].tolist()], pa.int64())})

    return run


def _counts(model):
    """How many windows of a partition there are by what they are for, class and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, size = model.value, 2 * TOP * BINS
        total = np.zeros(4 * size, np.int64)
        for batch in batches:
            texts, use = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for group in together(texts):
                codes, start, end, y, of = _learned(texts[group])
                score = np.clip(np.floor(net.margins(codes, start, end, of) * BINS).astype(np.int64) + TOP * BINS, 0, size - 1)
                np.add.at(total, (2 * use[group][of].astype(np.int64) + y) * size + score, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"_k": pa.array(at, pa.int32()), "_n": pa.array(total[at], pa.int64())})

    return run


def _summed(rows: DataFrame, made, net: Network) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and their sums over all partitions."""
    model = rows.sparkSession.sparkContext.broadcast(net)
    got = rows.mapInArrow(made(model), "_k int, _n long").groupBy("_k").agg(F.sum("_n").alias("_n")).toArrow()
    model.destroy()
    return got["_k"].to_numpy(), got["_n"].to_numpy()


def _step(rows: DataFrame, net: Network, move) -> int:
    """Move the weights against the mean gradient of all windows with a loss; returns how many windows were read."""
    at, n = _summed(rows, _gradient, net)
    sums = dict(zip(at.tolist(), n.tolist(), strict=True))
    if sums.get(-1, 0):
        flat = np.zeros(sum(v.size for v in net.p.values()))
        flat[at[at >= 0]] = n[at >= 0] / UNIT / sums[-1]
        ends = np.cumsum([v.size for v in net.p.values()])[:-1]
        move({k: g.reshape(v.shape).astype(np.float32) for (k, v), g in zip(net.p.items(), np.split(flat, ends), strict=True)})
    return sums.get(-2, 0)


def _calibrate(net: Network, measure: np.ndarray, counts: np.ndarray, recall: float) -> None:
    """Set map, threshold and report from counts by class and score."""
    edge = np.arange(counts.shape[1]) / BINS - TOP
    y, at = np.nonzero(counts)
    net.scale, net.shift = platt(edge[at] + 0.5 / BINS, y, weight=counts[y, at].astype(np.float64))
    secrets = np.cumsum(counts[1])
    cut = int(np.searchsorted(secrets, int((1 - recall) * secrets[-1]), "right"))
    net.threshold = float(sigmoid(net.scale * edge[cut] + net.shift))
    if measure.sum(axis=1).all():
        found = measure[:, cut:].sum(axis=1)
        net.report |= {"windows": int(measure.sum()), "secrets": int(measure[1].sum()), "recall": float(found[1] / measure[1].sum()), "precision": float(found[1] / found.sum()) if found.any() else 1.0}


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE, documents: int = 20_000, rate: float = 0.001, recall: float = RECALL, **options) -> Network:
    """Train on, and calibrate and measure with, all windows of all documents.

    The training starts from at most ``sample`` windows of each class, out of all documents with a base finding and at most
    ``documents`` others (lowest hash of the id). Texts are written once, a folder for each part, so that each step reads
    only its own part: with start, counts and scan every text is read about four times.
    """
    every = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")).withColumn("_part", F.pmod(F.xxhash64("_text"), F.lit(PARTS)).cast("int"))
    every = staged(every, "secret-parts", by=("_part",), compression="zstd")

    def start(rows: DataFrame) -> Network | None:
        ids = rows.select("_id").distinct().orderBy(F.xxhash64("_id"), "_id").limit(documents)
        own = rows.join(F.broadcast(ids.withColumn("_chosen", F.lit(True))), "_id", "left").select("_text", F.coalesce("_chosen", F.lit(False)))
        found = staged(own.mapInArrow(_starting(sample), "_h long, _x binary, _k int").dropDuplicates(["_h", "_k"]), "secret-windows")
        got = [r for k in range(3) for r in found.where(F.col("_k") == k).orderBy("_h").limit(sample).toArrow().to_pylist()]
        got.sort(key=lambda r: (r["_h"], r["_k"]))
        y = np.array([int(r["_k"] == 0) for r in got], np.int64)
        return started([bytes(r["_x"]) for r in got], y, **options) if len({*y.tolist()}) == 2 else None

    def counted(rows: DataFrame, use) -> np.ndarray:
        at, n = _summed(rows.select("_text", use.cast("int").alias("_use")), _counts, net)
        total = np.zeros(8 * TOP * BINS, np.int64)
        total[at] = n
        return total.reshape(2, 2, -1)

    trains = range(2 * HELD, PARTS)
    net = start(every.where(F.col("_part") >= 2 * HELD))
    if net is None:
        trains, net = range(PARTS), start(every)
    if net is None:
        return Network()  # its threshold is never reached
    move, read = _adam(net, rate), 0
    for part in trains:
        read += _step(every.where(F.col("_part") == part).select("_text"), net, move)
    net.report = {"trained": read}
    measure, counts = counted(every.where(F.col("_part") < 2 * HELD), F.col("_part") >= HELD)
    if len(trains) == PARTS or not counts.sum(axis=1).all() or not measure.sum(axis=1).all():
        for part in range(trains[0]):  # too few to hold any back
            net.report["trained"] += _step(every.where(F.col("_part") == part).select("_text"), net, move)
        measure, counts = counted(every, F.lit(1))
    _calibrate(net, measure, counts, recall)
    return net


def _model_spans(texts: list[str], bases: list[list[Span]], net: Network) -> list[list[Span]]:
    """Of each text, the candidates over the threshold that no base finding overlaps; a run is found once, whichever of its windows tell."""
    spans: list[list[Span]] = [[] for _ in texts]
    if net.threshold > 1:
        return spans  # no probability reaches it
    codes, first, base = joint(texts, bases)
    a, b, known = candidates(codes, base)
    a, b = a[~known], b[~known]
    run, start, end = windows(a, b)
    several = (np.searchsorted(first, start, "right") - 1,) if len(texts) > 1 else ()
    found = np.unique(run[net.probability(codes, start, end, *several) >= net.threshold])
    of = np.searchsorted(first, a[found], "right") - 1
    for i, x, y in zip(of.tolist(), (a[found] - first[of]).tolist(), (b[found] - first[of]).tolist(), strict=True):
        spans[i].append(("model", x, y))
    return spans


def scan_text(text: str, net: Network) -> tuple[list[Span], list[Span]]:
    """Base findings, and all findings, of one text."""
    base = base_spans(text)
    return base, in_order(base + _model_spans([text], [base], net)[0])


def _scan(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            bases = [base_spans(t) for t in texts]
            added = [x for group in together(texts) for x in _model_spans(texts[group], bases[group], net)]
            every = [x + y for x, y in zip(bases, added, strict=True)]
            counts = {f"n_{k}": pa.array([sum(s[0] == k for s in x) for x in every], pa.int64()) for k in KINDS}
            last = {"n_model": counts.pop("n_model")}
            sums = [hashlib.sha256(joined(x).encode()).hexdigest() for x in bases]
            spans = [joined(in_order(x)) for x in every]
            yield pa.RecordBatch.from_pydict({"_id": b.column(0)} | counts | {"base_sha256": pa.array(sums, pa.string()), "spans": pa.array(spans, pa.string())} | last)

    return run


def scan(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts by kind, digest of the base findings, and all spans."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    out = rows.mapInArrow(_scan(docs.sparkSession.sparkContext.broadcast(net)), f"_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long")
    return out.withColumnRenamed("_id", id_col)

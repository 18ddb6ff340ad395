"""Array-at-a-time tokenising and hashing of Arrow string columns.

Everything here works on the bytes of a whole slice of documents at once, so
no Python object is made per word. A word is a maximal run of ASCII letters
(lower-cased), digits and bytes of non-ASCII characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer document is handled alone.
SLICE_BYTES = 1_000_000

WORD_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
LOWER_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))

_RNG = np.random.default_rng(20260101)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_WORD_LUT = np.frombuffer(WORD_TABLE, np.uint8).copy()
_WORD_LUT[_WORD_LUT == 0x20] = 0
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE_MUL = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_table(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, _PRIME, np.uint64)])


_POW = _power_table(64)


def _powers(n: int) -> np.ndarray:
    """The first powers of the prime, at least ``n``; longer tables begin with the shorter ones."""
    global _POW
    if n > len(_POW):
        _POW = _power_table(2 * n)
    return _POW


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and the n + 1 offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = texts.buffers()
    offs = np.frombuffer(offs, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def slices(texts: pa.Array, max_bytes: int = SLICE_BYTES, max_docs: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``max_bytes`` of text, or one document."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offs = raw(texts)
    lo, n = 0, len(texts)
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n, lo + max_docs)
        yield lo, hi
        lo = hi


def word_spans(x: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document offsets (n + 1) of maximal runs of ``is_word`` that stay inside a document."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    inner = offs[:-1][(offs[:-1] < n)]
    before[inner] = False
    starts = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    ends = offs[1:][offs[1:] > 0] - 1
    after[ends] = False
    lens = np.flatnonzero(is_word & ~after) + 1 - starts
    return starts, lens, np.searchsorted(starts, offs)


def hash_spans(x: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum())) - np.repeat(first, lens)
    v = _BYTE[x[at + np.repeat(starts, lens)]] * _powers(int(lens.max()))[at]
    return mix(np.add.reduceat(v, first))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and the word offsets of the documents (n + 1)."""
    data, offs = raw(texts)
    x = _WORD_LUT[data]
    starts, lens, docs = word_spans(x, offs, x != 0)
    return hash_spans(x, starts, lens), docs


def shingles(h: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, and their document offsets.

    A document of fewer words, but not none, has one window of all its words.
    """
    n = np.diff(offs)
    full = np.maximum(n - width + 1, 0)
    count = np.where((n > 0) & (full == 0), 1, full)
    out = np.zeros(int(count.sum()), np.uint64)
    to = np.r_[0, np.cumsum(count)]
    if not len(out):
        return out, to
    at = np.repeat(offs[:-1], count) + np.arange(len(out)) - np.repeat(to[:-1], count)
    end = np.repeat(offs[1:], count)
    for j in range(width):
        if len(h):
            p = np.minimum(at + j, len(h) - 1)
            out += np.where(at + j < end, h[p], np.uint64(0)) * _SHINGLE_MUL[j]
    return mix(out), to


def text_slices(batch: pa.RecordBatch, text_at: int, max_bytes: int = SLICE_BYTES, max_docs: int = 1 << 30) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded text size."""
    for lo, hi in slices(batch.column(text_at), max_bytes, max_docs):
        yield batch.slice(lo, hi - lo)


#: Rows and bytes of an Arrow batch between Spark and Python, at most; texts are long, and batches are held on both sides.
BATCH_ROWS = "1000"
BATCH_BYTES = "8m"


def small_batches(df) -> None:
    """Bound this session's Arrow batches for tables of texts."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

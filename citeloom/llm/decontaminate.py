"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The strings searched for are the windows of 13 consecutive words of the
benchmark items (all words of a shorter item). The search runs over word
numbers: the alphabet is the benchmark's own vocabulary, any other word is 0.
For each window length a table gives, for every block of two words, how far
the search may jump when a block ends at the current position; where it may not
jump, the hash of the block selects a bucket of windows with that suffix, and
direct comparison of all words confirms. Many positions are advanced at once
with numpy, each in its own stretch of the text.

Plan: the benchmark is cut into segments of at most ``SEGMENT_WORDS`` words that
share all but one word of a window, and the segments are dealt into blocks of about
``BLOCK_BYTES`` of text. Each block is one pass over the documents without an
exchange; its tables, some 40 bytes for each byte of the block, are broadcast
for that pass and destroyed before the next block is built. So what the driver
builds and what is broadcast is bounded whatever the benchmark's size. With one
block the pass gives the result as it is. With more, the first pass gives the
numbers of words, every pass writes only the documents that it hit, and what the
passes found is put together by id and text digest.

Defined results: null, empty and wordless texts have no words and are clean;
wordless items are no test; items of equal id are one item, those of a null id
are the item "" (the empty string); repeated rows are each searched; an empty
benchmark leaves every document clean; other columns are not read (``search``) or
kept as they are (``drop_contaminated``, which judges each row by its own text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.textvec import WORD_TABLE, text_slices
from citeloom.staging import fresh, staged

WINDOW = 13
#: Bytes of benchmark text whose windows are searched for in one pass, about.
BLOCK_BYTES = 2_000_000
SEGMENT_WORDS = 20_000
_EMPTY = np.zeros(0, np.int64)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split() if text else []


def _bits(n: int) -> int:
    return max(10, int(np.ceil(np.log2(max(2, n)))))


class WuManber:
    """All windows of one length ``m``: row i is ``ids[at[i] : at[i] + m]``, all rows different."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, m: int):
        self.ids, self.m, self.n = ids, m, len(at)
        self.b = min(2, m)
        self.wide, self.narrow = _bits(2 * self.n * m), _bits(2 * self.n)
        self.shift = np.full(1 << self.wide, m - self.b + 1, np.uint16 if m > 250 else np.uint8)
        for end in range(self.b - 1, m):
            np.minimum.at(self.shift, self._code(ids[at + end - self.b + 1], ids[at + end], self.wide), m - 1 - end)
        suffix = self._code(ids[at + m - self.b], ids[at + m - 1], self.narrow)
        self.order = np.argsort(suffix, kind="stable").astype(np.int32)
        self.at = at[self.order].astype(np.int32)
        self.bucket = np.searchsorted(suffix[self.order], np.arange((1 << self.narrow) + 1)).astype(np.int32)

    @staticmethod
    def _code(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
        h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
        return ((h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)).astype(np.int64)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End positions of all occurrences, and which row occurs there."""
        n, m = len(ids), self.m
        if n < m:
            return _EMPTY, _EMPTY
        edges = np.linspace(m - 1, n, max(1, min(8192, n // 64)) + 1).astype(np.int64)
        at, stop = edges[:-1], edges[1:]
        ends, found, back = [], [], np.arange(1 - m, 1)
        while len(at):
            a, b = ids[at - self.b + 1], ids[at]
            jump = self.shift[self._code(a, b, self.wide)]
            stay = np.flatnonzero(jump == 0)
            if len(stay):
                c, p = self._code(a[stay], b[stay], self.narrow), at[stay]
                lo, count = self.bucket[c], self.bucket[c + 1] - self.bucket[c]
                rep = np.repeat(np.arange(len(p)), count)
                row = np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count) + lo[rep]
                same = ids[p[rep] - m + 1] == self.ids[self.at[row]]
                rep, row = rep[same], row[same]
                same = (ids[p[rep][:, None] + back] == self.ids[self.at[row][:, None] + back + m - 1]).all(axis=1)
                ends.append(p[rep[same]])
                found.append(self.order[row[same]].astype(np.int64))
            at = at + np.maximum(jump, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        return (np.concatenate(ends), np.concatenate(found)) if ends else (_EMPTY, _EMPTY)


class Patterns:
    """The windows of some benchmark texts, by length, and which items hold each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.vocab: dict[bytes, int] = {}
        self.names = sorted({k for k, _ in items})
        number = {k: i for i, k in enumerate(self.names)}
        ids, by_length, at = [], {}, 0
        for k, text in items:
            own = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(text)]
            ids.append(np.array(own, np.int32))
            m = min(window, len(own))
            if m:
                starts = np.arange(at, at + len(own) - m + 1)
                by_length.setdefault(m, []).append((starts, np.full(len(starts), number[k])))
            at += len(own)
        ids = np.concatenate([np.zeros(0, np.int32), *ids])
        self.groups = []
        for m, parts in sorted(by_length.items()):
            starts, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
            rows = np.ascontiguousarray(ids[starts[:, None] + np.arange(m)])
            _, first, which = np.unique(rows.view([("", np.int32)] * m).ravel(), return_index=True, return_inverse=True)
            pairs = np.unique(which.astype(np.int64) * len(self.names) + owner)
            lo = np.searchsorted(pairs, np.arange(len(first) + 1) * len(self.names))
            self.groups.append((WuManber(ids, starts[first], m), lo, (pairs % len(self.names)).astype(np.int32)))

    def search(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word offsets of the texts (a gap of one between them), covered words as 0/1, and (text, item) pairs."""
        get, ids, offs = self.vocab.get, [], [0]
        for t in texts:
            ids += [get(w, 0) for w in words(t)]
            ids.append(0)
            offs.append(len(ids))
        ids, offs = np.array(ids, np.int32), np.array(offs, np.int64)
        cover, docs, items = np.zeros(len(ids) + 1, np.int32), [], []
        for one, lo, owner in self.groups:
            end, row = one.search(ids)
            np.add.at(cover, end - one.m + 1, 1)
            np.add.at(cover, end + 1, -1)
            count = lo[row + 1] - lo[row]
            rep = np.repeat(np.arange(len(row)), count)
            items.append(owner[np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count) + lo[row][rep]])
            docs.append(np.searchsorted(offs, end, "right")[rep] - 1)
        return offs, (np.cumsum(cover[:-1]) > 0).astype(np.uint8), np.concatenate([_EMPTY, *docs]), np.concatenate([_EMPTY, *items])


def _segments(window: int):
    """Texts as segments of at most ``SEGMENT_WORDS`` words; every window of a text lies in one of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = words(t)
                parts = [" ".join(x.decode("utf-8", "replace") for x in w[i : i + SEGMENT_WORDS + window - 1]) for i in range(0, max(1, len(w) - window + 1), SEGMENT_WORDS)]
                yield pa.RecordBatch.from_pydict({"k": pa.array([k] * len(parts), pa.string()), "n": pa.array(range(len(parts)), pa.int32()), "t": pa.array(parts, pa.string())})

    return run


def pattern_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int) -> tuple[int, Iterator[Patterns]]:
    """How many blocks the benchmark has, and the blocks one after the other; the driver holds one at a time."""
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("k"), F.col(text_col).cast("string").alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    if n > 1:
        rows = staged(rows.mapInArrow(_segments(window), "k string, n int, t string").withColumn("b", F.pmod(F.xxhash64("k", "n", "t"), F.lit(n))), "benchmark-segments")
    own = lambda i: rows if n == 1 else rows.where(F.col("b") == i)
    return n, (Patterns([(r.k, r.t) for r in own(i).select("k", "t").toLocalIterator()], window) for i in range(n))


def _text_of(batch: pa.RecordBatch, at: int) -> list[str | None]:
    return batch.column(at).cast(pa.string()).to_pylist()


def _pass(patterns, only_hits: bool):
    """Of each document (or each hit one): id, digest, number of words, hit words as a packed bit row, items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = patterns.value
        for whole in batches:
            for batch in text_slices(whole, 1):
                texts = _text_of(batch, 1)
                offs, cover, docs, items = search.search(texts)
                told: list[set] = [set() for _ in texts]
                for d, i in set(zip(docs.tolist(), items.tolist(), strict=True)):
                    told[d].add(search.names[i])
                at = [i for i, x in enumerate(told) if x or not only_hits]
                if not at:
                    continue
                yield pa.RecordBatch.from_pydict(
                    {
                        "_id": batch.column(0).take(pa.array(at, pa.int64())),
                        "_sha": batch.column(2).take(pa.array(at, pa.int64())),
                        "n_words": pa.array([int(offs[i + 1] - offs[i] - 1) for i in at], pa.int64()),
                        "_cover": pa.array([np.packbits(cover[offs[i] : offs[i + 1] - 1]).tobytes() if told[i] else None for i in at], pa.binary()),
                        "_items": pa.array([sorted(told[i]) for i in at], pa.list_(pa.string())),
                    }
                )

    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Covers and items of the passes of each document put together."""
    for b in batches:
        hits, names = [], []
        for covers, items in zip(b.column("_covers").to_pylist(), b.column("_lists").to_pylist(), strict=True):
            rows = [np.frombuffer(x, np.uint8) for x in covers or ()]
            hits.append(int(np.unpackbits(np.bitwise_or.reduce(rows)).sum()) if rows else 0)
            names.append(sorted({k for x in items or () for k in x}))
        yield pa.RecordBatch.from_pydict(
            {
                "_id": b.column("_id"),
                "n_words": b.column("n_words"),
                "n_hit": pa.array(hits, pa.int64()),
                "n_items": pa.array([len(x) for x in names], pa.int64()),
                "items": pa.array(names, pa.list_(pa.string())),
                "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
            }
        )


def _sha(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _one_pass(rows: DataFrame, block: Patterns, run: Callable, schema: str) -> DataFrame:
    """The staged result of one block over all rows; its tables are on the executors for that long only."""
    sent = rows.sparkSession.sparkContext.broadcast(block)
    done = staged(rows.mapInArrow(run(sent), schema), "benchmark-hits")
    sent.destroy()
    return done


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_share: int = 20,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: words, hit words, items found and ``contaminated``.

    A document is contaminated when at least one in ``min_share`` words is hit.
    """
    sc = docs.sparkSession.sparkContext
    n, blocks = pattern_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), (_sha(text) if n > 1 else F.lit(None).cast("string")).alias("_sha"))
    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, _sha string, n_words long, _cover binary, _items array<string>"
    if n == 1:
        found = rows.mapInArrow(_pass(sc.broadcast(next(blocks)), False), schema)
        found = found.select("_id", "n_words", F.array_compact(F.array("_cover")).alias("_covers"), F.array("_items").alias("_lists"))
    else:
        every = hits = None
        for block in blocks:
            part = _one_pass(rows, block, lambda sent, first=every is None: _pass(sent, not first), schema)
            every = every or part.select("_id", "_sha", "n_words")
            part = part.where(F.size("_items") > 0).drop("n_words").dropDuplicates(["_id", "_sha"])
            hits = part if hits is None else hits.unionByName(part)
        hits = hits.groupBy(F.col("_id").alias("_k"), F.col("_sha").alias("_t")).agg(F.collect_list("_cover").alias("_covers"), F.collect_list("_items").alias("_lists"))
        found = every.join(hits, F.col("_id").eqNullSafe(F.col("_k")) & (F.col("_sha") == F.col("_t")), "left").select("_id", "n_words", "_covers", "_lists")
    out = found.mapInArrow(_sum, f"_id {kind}, n_words long, n_hit long, n_items long, items array<string>, items_sha256 string")
    return out.select(
        F.col("_id").alias(id_col), "n_words", "n_hit", "n_items", "items", "items_sha256", ((F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated")
    )


def _clean(patterns, text_at: int):
    """The rows without any window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = patterns.value
        for whole in batches:
            for batch in text_slices(whole, text_at):
                stays = np.ones(batch.num_rows, bool)
                stays[search.search(_text_of(batch, text_at))[2]] = False
                if stays.any():
                    yield batch.filter(pa.array(stays))

    return run


def _hit_texts(patterns):
    """The digests (column 1) of the texts (column 0) that hold a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = patterns.value
        for whole in batches:
            for batch in text_slices(whole, 0):
                at = np.unique(search.search(_text_of(batch, 0))[2])
                if len(at):
                    yield pa.RecordBatch.from_pydict({"_hit": batch.column(1).take(pa.array(at))})

    return run


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents, all columns, without the rows whose text holds any window of any item, however small its share.

    One block is a filter over whole rows. With more, each pass writes the digests of
    the texts that it hit, and one anti join by digest drops the rows of them all.
    """
    n, blocks = pattern_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    if n == 1:
        at = [c.lower() for c in docs.columns].index(text_col.lower())
        return docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(next(blocks)), at), docs.schema)
    text, name = docs[text_col].cast("string"), fresh(docs, "_hit")
    gone = None
    for block in blocks:
        part = _one_pass(docs.select(text, _sha(text)), block, _hit_texts, "_hit string")
        gone = part if gone is None else gone.unionByName(part)
    gone = staged(gone.select(F.col("_hit").alias(name)).distinct(), "benchmark-hits")
    return docs.join(gone, _sha(text) == gone[name], "left_anti")

"""Importance resampling of documents towards a target distribution of word n-grams.

A feature is a run of 1 to ``ORDER`` words, its bucket the CRC-32 of its UTF-8 bytes
modulo ``BUCKETS``. A bucket gains floor(1000 * ln(...)) of its smoothed share in the
target over its smoothed share in the documents; a document weighs the floored mean of
its features' gains, and the draw without replacement by these weights takes the
largest sums of weight and Gumbel noise, which is a hash of seed and id.

Plan. Each task hands slices of about ``SLICE_BYTES`` of text to a DuckDB database of
its own: SQL cuts words, unnests them, pairs each with the next one by a window, and
counts buckets by the registered function ``crc``, which sees each distinct feature of a
slice once. A text longer than a slice comes as several pieces, cut between words, each
with the last word of the piece before it, and its buckets are added up. Every document's
buckets are written as Parquet, and each task's sums with them (one row of ``BUCKETS``
numbers), so texts are read once and the totals cost one row for each task. Spark adds
the sums, and scores documents by the ``BUCKETS`` gains, which are broadcast.
Ranks need no single sorted task: scores are whole numbers of a bounded range, so a count
for each score finds the lowest score that is drawn, and only rows from there on are
sorted, by ranges; a range's first rank comes from the sizes of those before it.

Defined results: a null or empty text has no features and weight 0; a null id is hashed
as an empty one and stands last among ties; repeated rows are drawn by their own rank;
empty tables give an empty result, an empty target gives gains of the smoothing alone;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.textvec import slices, small_batches
from citeloom.staging import staged

BUCKETS, SEED = 10_000, 7
MIN_WORDS, PERCENT = 20, 25
#: Bytes of text that one SQL call sees.
SLICE_BYTES = 2_000_000
_MEMORY = "400MB"

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: Buckets of the rows of ``slice`` (row, carry, text); carry is the word before the text, which counts in pairs only.
_COUNT = f"""
WITH cut AS (
  SELECT row, carry, {_WORDS} AS w FROM slice
), words AS (
  SELECT row, 0 AS pos, carry AS word FROM cut WHERE carry IS NOT NULL
  UNION ALL SELECT row, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM cut
), pairs AS (
  SELECT row, pos, word, lead(word) OVER (PARTITION BY row ORDER BY pos) AS next FROM words
), features AS (
  SELECT row, word AS feature FROM pairs WHERE pos > 0
  UNION ALL SELECT row, word || ' ' || next FROM pairs WHERE next IS NOT NULL
), named AS (
  SELECT feature, crc(feature) % {{buckets}} AS bucket FROM (SELECT DISTINCT feature FROM features)
), counted AS (
  SELECT row, bucket, count(*) AS n FROM features JOIN named USING (feature) GROUP BY row, bucket
), lists AS (
  SELECT row, list(CAST(bucket AS INTEGER) ORDER BY bucket) AS buckets, list(n ORDER BY bucket) AS counts FROM counted GROUP BY row
)
SELECT row, CAST(len(w) AS BIGINT) AS n_words, buckets, counts FROM cut LEFT JOIN lists USING (row) ORDER BY row
"""
#: Where a long text may be cut: before a byte that is no part of a word.
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LAST = re.compile(rb"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\Z")


def crc32_of(strings: pa.Array) -> pa.Array:
    """Unsigned zlib CRC-32 of the UTF-8 bytes of each string."""
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.combine_chunks()
    _, offs, data = strings.buffers()
    at = np.frombuffer(offs, np.int64 if strings.type == pa.large_string() else np.int32)[strings.offset : strings.offset + len(strings) + 1].tolist()
    view, crc = memoryview(data if data is not None else b""), zlib.crc32
    return pa.array([crc(view[i:j]) for i, j in zip(at, at[1:], strict=False)], pa.uint32())


def long_pieces(text: str, size: int) -> Iterator[tuple[str | None, str]]:
    """(last word before the piece, piece): the text in pieces of about ``size`` bytes, no word cut."""
    data, lo, carry = text.encode(), 0, None
    while lo < len(data):
        gap = _GAP.search(data, min(len(data), lo + size))
        hi = gap.start() if gap else len(data)
        piece = data[lo:hi]
        yield carry, piece.decode()
        last = _LAST.search(piece[-1_000_000:] if size > 1_000_000 else piece) or _LAST.search(piece)
        carry = last.group(1).decode().translate(_LOWER) if last else carry
        lo = hi


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


class Counter:
    """A task's DuckDB database."""

    def __init__(self, buckets: int):
        import duckdb

        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": _MEMORY})
        self.db.create_function("crc", crc32_of, ["VARCHAR"], "UINTEGER", type="arrow")
        self.sql, self.buckets = _COUNT.format(buckets=buckets), buckets

    def count(self, carries: list[str | None], texts: pa.Array) -> pa.Table:
        """row, n_words, buckets and counts of each text, in their order."""
        rows = pa.table({"row": pa.array(range(len(texts)), pa.int64()), "carry": pa.array(carries, pa.string()), "text": texts.cast(pa.string()).fill_null("")})
        self.db.register("slice", rows)
        out = self.db.sql(self.sql).to_arrow_table()
        self.db.unregister("slice")
        return out

    def long(self, text: str) -> pa.Table:
        """The same for one long text, a piece at a time."""
        total, words = np.zeros(self.buckets, np.int64), 0
        for carry, piece in long_pieces(text, SLICE_BYTES):
            got = self.count([carry], pa.array([piece]))
            words += got.column("n_words")[0].as_py()
            if got.column("buckets")[0].is_valid:
                total[np.array(got.column("buckets")[0].values)] += np.array(got.column("counts")[0].values)
        held = np.flatnonzero(total)
        return pa.table({"row": pa.array([0], pa.int64()), "n_words": pa.array([words], pa.int64()), "buckets": pa.array([held.tolist()], pa.list_(pa.int32())), "counts": pa.array([total[held].tolist()], pa.list_(pa.int64()))})


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column one after the other, and its sizes; null is an empty list."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = pa.concat_arrays(a.chunks) if a.num_chunks else pa.array([], column.type)
    sizes = a.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    return a.flatten().to_numpy().astype(np.int64), sizes


def _count(buckets: int):
    """Rows (_id, n_words, buckets, counts) of documents (_id, _text), and a last one with the task's sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, total, kind = Counter(buckets), np.zeros(buckets, np.int64), None
        for batch in batches:
            kind = batch.column(0).type
            for lo, hi in slices(batch.column(1), SLICE_BYTES):
                texts = batch.column(1).slice(lo, hi - lo)
                one = texts[0].as_py() if len(texts) == 1 else None
                got = counter.long(one) if one and len(one) > SLICE_BYTES // 4 and len(one.encode()) > SLICE_BYTES else counter.count([None] * len(texts), texts)
                held, _ = _flat(got.column("buckets"))
                counts, sizes = _flat(got.column("counts"))
                np.add.at(total, held, counts)
                offs = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                yield pa.RecordBatch.from_pydict(
                    {
                        "_id": batch.column(0).slice(lo, hi - lo), "n_words": got.column("n_words").combine_chunks(), "buckets": pa.ListArray.from_arrays(offs, pa.array(held.astype(np.int32))),
                        "counts": pa.ListArray.from_arrays(offs, pa.array(counts)), "sums": pa.nulls(hi - lo, pa.list_(pa.int64())),
                    }
                )
        if kind is not None:
            none = pa.nulls(1, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict({"_id": pa.nulls(1, kind), "n_words": pa.nulls(1, pa.int64()), "buckets": none.cast(pa.list_(pa.int32())), "counts": none, "sums": pa.array([total.tolist()], pa.list_(pa.int64()))})

    return run


def bucket_counts(docs: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> DataFrame:
    """Staged (_id, n_words, buckets, counts, sums): a row for each document, and a row for each task with only ``sums``."""
    small_batches(docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return staged(rows.mapInArrow(_count(buckets), f"_id {kind}, n_words long, buckets array<int>, counts array<long>, sums array<long>"), "resample-counts")


def totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs, over all tasks: ``buckets`` numbers."""
    out = np.zeros(buckets, np.int64)
    for r in counted.where("sums is not null").select(F.posexplode("sums").alias("b", "n")).groupBy("b").agg(F.sum("n").alias("n")).where("n > 0").collect():
        out[r.b] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed shares' ratio) of each bucket, in doubles."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weigh(gain: np.ndarray):
    """n_features and weight of documents from their buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, sizes = _flat(b.column("buckets"))
            counts, _ = _flat(b.column("counts"))
            ends = np.cumsum(sizes)
            at = np.r_[0, ends]
            features, worth = np.r_[0, np.cumsum(counts)], np.r_[0, np.cumsum(counts * gain[held])]
            n, sums = features[at[1:]] - features[at[:-1]], worth[at[1:]] - worth[at[:-1]]
            yield pa.RecordBatch.from_pydict({"_id": b.column("_id"), "n_words": b.column("n_words"), "n_features": pa.array(n), "weight": pa.array(np.where(n > 0, sums // np.maximum(n, 1), 0))})

    return run


def _ranked(rows: DataFrame, order: list) -> DataFrame:
    """Staged rows with their ``rank`` in the order, from 1: sorted by ranges, each starting after those before it."""
    at = F.monotonically_increasing_id()  # partition number above 33 bits of row number
    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "resample-sorted")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row for each range
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return placed.join(before, part == F.col("_part")).withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_part", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_id: str = "item_id",
    target_text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, n_features, weight, score, and rank where it is drawn.

    Of the N documents with at least ``min_words`` words floor(``percent`` * N / 100) are drawn.
    """
    own = bucket_counts(docs, id_col, text_col, buckets)
    wanted = bucket_counts(target, target_id, target_text, buckets)
    gain = gains(totals(own, buckets), totals(wanted, buckets))
    kind = own.schema["_id"].dataType.simpleString()
    weighed = own.where("sums is null").select("_id", "n_words", "buckets", "counts").mapInArrow(_weigh(gain), f"_id {kind}, n_words long, n_features long, weight long")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = staged(weighed.withColumn("score", F.col("weight") + noise), "resample-scores")

    # scores are integers of some 100,000 values at most: 1000 times logarithms of counts and of 32-bit hashes
    eligible = scored.where(F.col("n_words") >= min_words)
    level = eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    above = level.withColumn("upto", F.sum("n").over(Window.orderBy(F.desc("score"))))
    top = above.agg(F.max("upto").alias("all")).first()["all"] or 0
    draw = percent * top // 100
    lowest = above.where(F.col("upto") >= draw).agg(F.max("score")).first()[0]
    no_rank = scored.withColumn("rank", F.lit(None).cast("long"))
    if not draw:
        out = no_rank
    else:
        drawn = F.coalesce((F.col("n_words") >= min_words) & (F.col("score") >= lowest), F.lit(False))
        ranked = _ranked(scored.where(drawn), [F.desc("score"), F.asc_nulls_last("_id"), F.asc("n_features"), F.asc("weight")])
        ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
        out = ranked.unionByName(no_rank.where(~drawn))
    return out.select(F.col("_id").alias(id_col), "n_features", "weight", "score", "rank")

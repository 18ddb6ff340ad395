"""Packing documents into training sequences by cutting-stock column generation.

A document's token ids, and one end id, are cut into pieces of ``length`` ids and a
rest that is shorter. Full pieces are sequences by themselves. The rests are the items
of a cutting-stock problem: how many there are of each length is all that it reads.

* **Linear program.** Minimise the number of sequences over patterns, the multisets of
  lengths that fit into one. The revised simplex method runs on the driver with a row for
  each length that occurs, fewer than ``length`` whatever the number of documents. It
  starts from the patterns of first fit decreasing, which form a triangular basis.
* **Pricing.** An unbounded knapsack over the capacity, solved by dynamic programming
  with the duals as values; its table gives the best pattern through each length. Rounds
  end when no pattern improves, when no packing can be better by more than ``GAP``, or
  after ``PIVOTS`` pivots; each state of the simplex method is a feasible packing.
* **Rounding.** Patterns are taken as often as their values' integer parts. What is then
  left, some items for each pattern of the basis, is one more pattern, taken once.
* **Padding.** A pattern that leaves at most ``WASTE`` of a sequence is laid out as it is. The
  items of one that leaves more, and those that rounding left, are laid out one after the
  other and cut at the ends of sequences, which then are full but for the last one.
* **Assignment.** Items of one length are ranked, by task and by order in the task, and
  each pattern owns a range of ranks of each of its lengths. So a rest finds its sequence
  and its offset by a search in a table of at most some thousand ranges.

Plan: documents are tokenised once and their pieces written; full pieces are final.
Counts by (task, length) give the ranks by one window over each length; rests join them on
(task, length), a key that no more rests share than a task has. Nothing but the histogram of
lengths (fewer than ``length`` rows) reaches the driver.

Defined results: a null or empty text is one end id; a null id is kept; each of repeated
rows is packed; an empty table gives no pieces; other columns are not read. A document is
tokenised as a whole, so its ids must fit into a task's memory. Which documents share a
sequence, and where rests are cut, depends on how the input is dealt to tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.textvec import slices, small_batches
from citeloom.llm.token_ids import token_ids
from citeloom.staging import staged

LENGTH = 1024
#: Share of a sequence that a pattern may leave empty and is not laid out with cuts.
WASTE = 0.004
#: Share of the sequences that the linear program may be off the least possible number.
GAP = 0.0005
PIVOTS = 1_500
#: Pivots between new inversions of the basis.
_FRESH = 200
_RANK_BITS = 48


# --- the linear program, on the histogram of lengths


def knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each capacity the largest value of a multiset of lengths, and one length of it (0: leave one place empty).

    ``value`` has the value of each length from 0 to the capacity, -inf where there is none.
    """
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        last = best[c - 1 :: -1] + value[1 : c + 1] if c > 1 else best[:1] + value[1:2]  # with an item of length 1..c placed last
        i = int(last.argmax())
        if last[i] > best[c - 1] + 1e-12:
            best[c], took[c] = last[i], i + 1
        else:
            best[c] = best[c - 1]
    return best, took


def filled(took: np.ndarray, capacity: int, uses: dict[int, int]) -> dict[int, int]:
    """``uses`` and the multiset that the knapsack's table has for a capacity."""
    uses = dict(uses)
    while capacity > 0:
        s = int(took[capacity])
        if s:
            uses[s] = uses.get(s, 0) + 1
        capacity -= s or 1
    return uses


def first_fit(counts: dict[int, int], length: int) -> list[tuple[int, dict[int, int], float]]:
    """(length, pattern, how often), first fit decreasing: each pattern is the last to use its length, so they form a triangular basis."""
    left, order, out = {s: float(n) for s, n in counts.items()}, sorted(counts, reverse=True), []
    while left:
        uses, free = {}, length
        for s in order:
            n = min(free // s, max(1, int(left[s])))
            if n:
                uses[s] = n
                free -= n * s
        times = min(left[s] / n for s, n in uses.items())
        for s, n in uses.items():
            left[s] = max(0.0, left[s] - n * times)
        gone = [s for s in uses if left[s] <= 1e-9]
        out.append((gone[0], uses, times))
        out += [(s, {s: length // s}, 0.0) for s in gone[1:]]  # used up by the same pattern
        for s in gone:
            del left[s]
        order = [s for s in order if s in left]
    return out


class Master:
    """The simplex method over patterns; ``x`` says how often each pattern of the basis is taken."""

    def __init__(self, counts: dict[int, int], length: int):
        self.length, self.sizes = length, np.array(sorted(counts), np.int64)
        self.row = {int(s): i for i, s in enumerate(self.sizes)}
        self.need = np.array([counts[int(s)] for s in self.sizes], float)
        self.least = float(self.sizes @ self.need) / length  # no packing has fewer sequences
        self.basis: list[dict[int, int]] = [{}] * len(self.sizes)
        for s, uses, _ in first_fit(counts, length):
            self.basis[self.row[s]] = uses
        self._invert()

    def _invert(self) -> None:
        matrix = np.zeros((len(self.sizes),) * 2)
        for j, uses in enumerate(self.basis):
            for s, n in uses.items():
                matrix[self.row[s], j] = n
        self.inverse = np.linalg.inv(matrix)
        self.x = np.maximum(self.inverse @ self.need, 0)
        self.y = self.inverse.sum(0)

    def _gain(self, uses: dict[int, int]) -> float:
        return sum(n * self.y[self.row[s]] for s, n in uses.items()) - 1

    def _pivot(self, uses: dict[int, int]) -> None:
        move = self.inverse[:, [self.row[s] for s in uses]] @ np.array(list(uses.values()), float)
        up = np.flatnonzero(move > 1e-9)
        ratio = self.x[up] / move[up]
        near = up[ratio <= ratio.min() + 1e-12]
        r = int(near[move[near].argmax()])
        step, line = self.x[r] / move[r], self.inverse[r] / move[r]
        self.y -= self._gain(uses) * line
        self.x = np.maximum(self.x - step * move, 0)
        self.x[r] = step
        move[r] -= 1
        self.inverse -= np.multiply.outer(move, line)
        self.basis[r] = uses

    def solve(self) -> None:
        """Rounds of pricing, each with as many pivots as its patterns still gain."""
        pivots = 0
        while pivots < PIVOTS and self.x.sum() > self.least * (1 + GAP):
            value = np.full(self.length + 1, -np.inf)
            value[self.sizes] = self.y
            best, took = knapsack(value, self.length)
            # the duals over the best pattern's value are feasible: what they are worth bounds every packing from below
            self.least = max(self.least, float(self.y @ self.need) / max(best[-1], 1e-9))
            through = self.y + best[self.length - self.sizes]
            found = [filled(took, self.length - int(self.sizes[i]), {int(self.sizes[i]): 1}) for i in np.argsort(-through, kind="stable") if through[i] > 1 + 1e-7]
            if not found:
                break
            for uses in found:
                if self._gain(uses) > 1e-7 and pivots < PIVOTS:
                    self._pivot(uses)
                    pivots += 1
                    if pivots % _FRESH == 0:
                        self._invert()


class Plan:
    """Where each (length, rank) of the items goes: ``starts`` are sorted codes of (length, first rank of a range)."""

    def __init__(self, counts: dict[int, int], length: int):
        left, self.sequences, self.padding, ranges = dict(counts), 0, 0, []

        def lay(uses: dict[int, int], times: int, at: int, sequence: int, stride: int) -> None:
            for s, k in sorted(uses.items(), reverse=True):
                ranges.append((s, counts[s] - left[s], k, at, sequence, stride))
                left[s] -= times * k
                at += s * k

        loose = []
        if counts:
            master = Master(counts, length)
            master.solve()
            taken = sorted(((sum(s * k for s, k in uses.items()), sorted(uses.items()), int(x + 1e-6)) for uses, x in zip(master.basis, master.x, strict=True)), reverse=True)
            for size, items, times in taken:
                uses = dict(items)
                times = min(times, *(left[s] // k for s, k in items))
                if not times:
                    continue
                if length - size > WASTE * length:
                    loose.append((size, uses, times))
                    continue
                lay(uses, times, 0, self.sequences, length)
                self.sequences += times
                self.padding += times * (length - size)
            at, first = 0, self.sequences
            for size, uses, times in loose:
                times = min(times, *(left[s] // k for s, k in uses.items()))
                lay(uses, times, at, first, size)
                at += times * size
            rest = {s: n for s, n in left.items() if n}
            lay(rest, 1, at, first, 0)
            at += sum(s * n for s, n in rest.items())
            self.sequences += -(-at // length)
            self.padding += -at % length
        table = np.array(sorted(ranges), np.int64).reshape(-1, 6)
        self.starts, self.table, self.length = table[:, 0] << _RANK_BITS | table[:, 1], table[:, 2:], length

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of items: row, start inside the item, length, sequence and offset of each of their pieces."""
        at = np.searchsorted(self.starts, length << _RANK_BITS | rank, "right") - 1
        each, first, sequence, stride = self.table[at].T
        nth = rank - (self.starts[at] & ((1 << _RANK_BITS) - 1))
        where = first + nth // each * stride + nth % each * length
        sequence, offset = sequence + where // self.length, where % self.length
        size = np.minimum(length, self.length - offset)
        cut = np.flatnonzero(size < length)
        none = np.zeros(len(length), np.int64)
        return np.r_[np.arange(len(length)), cut], np.r_[none, size[cut]], np.r_[size, (length - size)[cut]], np.r_[sequence, sequence[cut] + 1], np.r_[offset, none[cut]]


# --- on Spark


def _pieces(path: str, length: int, end_id: int):
    """Full pieces and rests of documents (_id, _text); rests know their task and their rank of their length in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = token_ids(path), TaskContext.get().partitionId()
        seen = np.zeros(length + 1, np.int64)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                ids = [x + end for x in encoder.encode([t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()])]
                row, start, cut, size, nth = [], [], [], [], []
                for i, x in enumerate(ids):
                    for s in range(0, len(x), 4 * length):
                        piece = x[s : s + 4 * length]
                        n = len(piece) // 4
                        row.append(i)
                        start.append(s // 4)
                        cut.append(piece)
                        size.append(n)
                        nth.append(int(seen[n]))
                        seen[n] += 1
                row = np.array(row, np.int64)
                tokens = np.array([len(x) // 4 for x in ids], np.int64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "_id": batch.column(0).slice(lo, hi - lo).take(pa.array(row)), "doc_tokens": pa.array(tokens[row]), "start": pa.array(start, pa.int64()), "length": pa.array(size, pa.int64()),
                        "ids": pa.array(cut, pa.binary()), "_part": pa.array(np.full(len(row), part, np.int64)), "_nth": pa.array(nth, pa.int64()),
                    }
                )

    return run


def _placed(table: np.ndarray, starts: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan({}, length)
        plan.table, plan.starts = table, starts
        for b in batches:
            row, start, size, sequence, offset = plan.places(b.column("length").to_numpy(), b.column("_rank").to_numpy())
            ids = b.column("ids").to_pylist()
            take = pa.array(row)
            yield pa.RecordBatch.from_pydict(
                {
                    "_id": b.column("_id").take(take), "doc_tokens": b.column("doc_tokens").take(take), "start": pa.array(b.column("start").to_numpy()[row] + start), "length": pa.array(size),
                    "ids": pa.array([ids[r][4 * s : 4 * (s + n)] for r, s, n in zip(row.tolist(), start.tolist(), size.tolist(), strict=True)], pa.binary()), "sequence_id": pa.array(sequence), "offset": pa.array(offset),
                }
            )

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = 0) -> DataFrame:
    """One row per piece: id, doc_tokens, start, length, ids (little-endian unsigned 32-bit numbers), sequence_id and offset.

    ``tokenizer`` is the path of a tokenizer file that driver and executors can read. Sequences of rests are numbered
    from 0; those of full pieces follow, with gaps.
    """
    small_batches(docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    pieces = staged(rows.mapInArrow(_pieces(tokenizer, length, end_id), f"_id {kind}, doc_tokens long, start long, length long, ids binary, _part long, _nth long"), "pack-pieces")
    full, rests = pieces.where(F.col("length") == length), pieces.where(F.col("length") < length)
    by_task = rests.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = staged(by_task.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))), "pack-ranks")
    plan = Plan({r.length: r.n for r in bases.groupBy("length").agg(F.sum("_n").alias("n")).collect()}, length)  # at most one row for each length
    ranked = rests.join(bases.select("_part", "length", "_base"), ["_part", "length"]).withColumn("_rank", F.col("_base") + F.col("_nth"))
    schema = f"_id {kind}, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long"
    packed = ranked.select("_id", "doc_tokens", "start", "length", "ids", "_rank").mapInArrow(_placed(plan.table, plan.starts, length), schema)
    alone = full.withColumn("sequence_id", F.lit(plan.sequences) + F.shiftleft("_part", 32) + F.col("_nth")).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone.select(*packed.columns)).withColumnRenamed("_id", id_col)


def piece_digests(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Pieces with the checksum of their ids in place of them."""
    return pieces.select(id_col, "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

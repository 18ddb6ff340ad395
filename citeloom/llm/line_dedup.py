"""Reversible line deduplication: cuckoo filters over exact reference counts.

The index has two tables, both sharded by the line key's hash:

* ``refs``: exact reference counts, one row per (key, document) with the number
  of its lines. Inserting documents adds rows, deleting documents takes theirs
  away again, so any insertion can be undone.
* ``filters``: per shard a cuckoo filter with the keys that at least
  ``min_docs`` documents hold. Keys enter when their count reaches that number
  and are deleted when it falls below it again.

Resolving documents asks the filters first, so that the exact table is only met
by lines that may be repeated (all that are, and few others). Lines of a
repeated key go, except in the largest document id that holds it.

Plan: lines are cut, hashed and counted per document while scanning, and staged;
counts per key are pre-aggregated before their exchange, so a line that a third
of all documents hold costs one row per map task. Line keys and filters meet by
shard: a shard of many lines is dealt over several groups of about ``GROUP_LINES``,
each with a copy of the shard's filter, so neither a hot line nor a large corpus
makes a large group, and no filter is broadcast. The join of what passes with the
exact table has one row per key on that side and small rows on the other, so AQE
may split a hot key.

Defined results: a null or empty text is one empty line; keys shorter than
``min_chars`` code points never count; rows of equal id are one document for
counting; null ids are no documents and lose repeated lines; an empty table
gives an empty index; other columns are kept by ``drop_repeated``. ``delete`` fails
when a document holds lines that the index does not have of it (it was never
inserted, or its text has changed); one without any counted line leaves no trace.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.textvec import LOWER_TABLE, mix, small_batches, text_slices
from citeloom.staging import fresh, staged

STRIP = " \t\n\x0b\x0c\r"
#: Keys of a shard, and lines that ask one copy of its filter, about.
SHARD_KEYS = 20_000
GROUP_LINES = 50_000
_SLOTS = 4


def line_key(line: str, min_chars: int) -> bytes | None:
    k = line.strip(STRIP)
    return hashlib.blake2b(k.encode("utf-8", "surrogatepass").translate(LOWER_TABLE), digest_size=16).digest() if len(k) >= min_chars else None


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four, each key in one of two buckets."""

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        size = 1 << max(4, int(np.ceil(np.log2(max(1, capacity) / _SLOTS / 0.85))))
        self.table = np.zeros((size, _SLOTS), np.uint16) if table is None else table
        self.stash: list[tuple[int, int]] = []

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        mark = np.maximum(h >> np.uint64(48), np.uint64(1)).astype(np.uint16)
        one = h & mask
        return mark, one, one ^ (mix(mark.astype(np.uint64)) & mask)

    def contains(self, h: np.ndarray) -> np.ndarray:
        mark, one, two = self._places(h)
        found = (self.table[one] == mark[:, None]).any(axis=1) | (self.table[two] == mark[:, None]).any(axis=1)
        for f, i in self.stash:
            found |= (mark == f) & ((one == i) | (two == i))
        return found

    def insert(self, h: np.ndarray) -> None:
        turn = 0
        for f, i, j in zip(*(x.tolist() for x in self._places(h)), strict=True):
            for at in (i, j):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = f
                    break
            else:
                at = i
                for _ in range(500):
                    turn = (turn + 1) % _SLOTS
                    f, self.table[at, turn] = int(self.table[at, turn]), f
                    at = int(np.uint64(at) ^ (mix(np.array([f], np.uint64))[0] & np.uint64(len(self.table) - 1)))
                    free = np.flatnonzero(self.table[at] == 0)
                    if len(free):
                        self.table[at, free[0]] = f
                        break
                else:
                    self.stash.append((f, at))

    def delete(self, h: np.ndarray) -> None:
        for f, i, j in zip(*(x.tolist() for x in self._places(h)), strict=True):
            for at in (i, j):
                if (f, at) in self.stash:
                    self.stash.remove((f, at))
                    break
                held = np.flatnonzero(self.table[at] == f)
                if len(held):
                    self.table[at, held[0]] = 0
                    break

    def load(self) -> int:
        return int((self.table > 0).sum()) + len(self.stash)

    def to_bytes(self) -> bytes:
        return np.array([len(self.stash)], np.int64).tobytes() + np.array(self.stash, np.int64).tobytes() + self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        out = cls(0, np.frombuffer(data, np.uint16, offset=8 + 16 * n).reshape(-1, _SLOTS).copy())
        out.stash = [tuple(x) for x in np.frombuffer(data, np.int64, 2 * n, 8).reshape(-1, 2).tolist()]
        return out


def key_hash(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64)[::2].copy() if keys else np.zeros(0, np.uint64)


def _lines_of(min_chars: int):
    """Rows (id, key, place of the key among the shards, number of lines) of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, 1):
                rows, keys, counts = [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    own: dict[bytes, int] = {}
                    for line in (text or "").split("\n"):
                        if (k := line_key(line, min_chars)) is not None:
                            own[k] = own.get(k, 0) + 1
                    rows += [i] * len(own)
                    keys += own
                    counts += own.values()
                if rows:
                    place = (key_hash(keys) >> np.uint64(24)).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"_id": batch.column(0).take(pa.array(rows, pa.int64())), "_key": pa.array(keys, pa.binary()), "_place": pa.array(place), "_n": pa.array(counts, pa.int64())})

    return run


def _ask(key: tuple, lines: pa.Table, held: pa.Table) -> pa.Table:
    """The lines of a group that their shard's filter has."""
    lines = lines.select(["_id", "_key"])
    if not held.num_rows or not lines.num_rows:
        return lines.slice(0, 0)
    known = CuckooFilter.from_bytes(held.column("filter")[0].as_py())
    return lines.filter(pa.array(known.contains(key_hash(lines.column("_key").to_pylist()))))


def _update(key: tuple, held: pa.Table, change: pa.Table) -> pa.Table:
    """One shard's filter after keys came (+1) and went (-1)."""
    signs = np.array(change.column("_sign").to_pylist(), np.int64)
    h = key_hash(change.column("_key").to_pylist())
    old = held.column("filter").to_pylist()
    n = int(held.column("n").to_pylist()[0] if old else 0) + int(signs.sum())
    f = CuckooFilter.from_bytes(old[0]) if old else CuckooFilter(2 * n)
    f.delete(h[signs < 0])
    f.insert(h[signs > 0])
    return pa.table({"_shard": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([n], pa.int64()), "filter": pa.array([f.to_bytes()], pa.binary())})


@dataclass
class LineIndex:
    """refs (_id, _key, _place, _n), repeated (_key, _place, _docs, _last) and filters (_shard, n, filter), all staged."""

    refs: DataFrame
    repeated: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int
    min_chars: int


def _repeated(refs: DataFrame, min_docs: int) -> DataFrame:
    return refs.groupBy("_key", "_place").agg(F.count_distinct("_id").alias("_docs"), F.max("_id").alias("_last")).where(F.col("_docs") >= min_docs)


def _changed(index: LineIndex | None, refs: DataFrame, min_docs: int, min_chars: int, shards: int | None) -> LineIndex:
    refs = staged(refs, "line-refs")
    repeated = staged(_repeated(refs, min_docs), "line-keys")
    n = repeated.count()
    if index is not None and n > 1.8 * (index.filters.agg(F.sum("n")).first()[0] or 0):
        index = None  # the filters are outgrown: build them anew
    if shards is None:
        shards = index.shards if index else max(1, -(-n // SHARD_KEYS))
    now = repeated.select("_key", "_place", F.lit(1).alias("_sign"))
    if index is None:
        held = refs.sparkSession.createDataFrame([], "_shard long, n long, filter binary")
    else:
        held = index.filters
        before = index.repeated.select("_key", "_place", F.lit(-1).alias("_sign"))
        now = now.unionByName(before).groupBy("_key", "_place").agg(F.sum("_sign").cast("int").alias("_sign")).where("_sign <> 0")
    change = now.select((F.col("_place") % shards).alias("_shard"), "_key", "_sign")
    touched = held.groupBy("_shard").cogroup(change.groupBy("_shard")).applyInArrow(_update, "_shard long, n long, filter binary")
    return LineIndex(refs, repeated, staged(touched, "line-filters"), shards, min_docs, min_chars)


def line_refs(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    small_batches(docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(_lines_of(min_chars), f"_id {rows.schema['_id'].dataType.simpleString()}, _key binary, _place long, _n long")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20, shards: int | None = None) -> LineIndex:
    """The index of some documents: their insertion into an empty one."""
    return _changed(None, line_refs(docs, id_col, text_col, min_chars), min_docs, min_chars, shards)


def _summed(index: LineIndex, change: DataFrame) -> DataFrame:
    return index.refs.unionByName(change).groupBy("_id", "_key", "_place").agg(F.sum("_n").alias("_n"))


def insert(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    return _changed(index, _summed(index, line_refs(docs, id_col, text_col, index.min_chars)), index.min_docs, index.min_chars, None)


def delete(index: LineIndex, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
    """Undo the insertion of exactly these documents."""
    old = line_refs(docs, id_col, text_col, index.min_chars).withColumn("_n", -F.col("_n"))
    refs = staged(_summed(index, old), "line-refs")
    if not refs.where("_n < 0").isEmpty():
        raise ValueError("some of these documents are not in the index as they are now")
    return _changed(index, refs.where("_n > 0"), index.min_docs, index.min_chars, None)


def maybe_repeated(lines: DataFrame, index: LineIndex) -> DataFrame:
    """Of lines (_id, _key, _place) those whose key is in the filters: all repeated ones and few others."""
    dealt = lines.select((F.col("_place") % index.shards).alias("_shard"), "_id", "_key")
    groups = staged(dealt.groupBy("_shard").agg(F.ceil(F.count(F.lit(1)) / GROUP_LINES).alias("_groups")), "line-groups")
    asked = dealt.join(groups, "_shard").select("_shard", F.pmod(F.xxhash64("_id", "_key"), "_groups").alias("_group"), "_id", "_key")
    copies = index.filters.join(groups, "_shard").select("_shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1)).alias("_group"), "filter")
    kind = lines.schema["_id"].dataType.simpleString()
    return asked.groupBy("_shard", "_group").cogroup(copies.groupBy("_shard", "_group")).applyInArrow(_ask, f"_id {kind}, _key binary")


def _cut(text_at: int, keys_col: str, min_chars: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, text_at):
                texts, lines, gone = [], [], []
                for text, keys in zip(b.column(text_at).to_pylist(), b.column(keys_col).to_pylist(), strict=True):
                    own = (text or "").split("\n")
                    keys = set(keys or ())
                    left = [x for x in own if line_key(x, min_chars) not in keys] if keys else own
                    texts.append("\n".join(left) if len(left) < len(own) else text)
                    lines.append(len(own))
                    gone.append(len(own) - len(left))
                names = [n for n in b.schema.names if n != keys_col]
                out = {n: b.column(n) for n in names} | {names[text_at]: pa.array(texts, pa.string())}
                if digest:
                    sums = [hashlib.sha256((t or "").encode("utf-8", "surrogatepass")).hexdigest() for t in texts]
                    out |= {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(gone, pa.int64()), "kept_sha256": pa.array(sums, pa.string())}
                yield pa.RecordBatch.from_pydict(out)

    return run


def _resolved(docs: DataFrame, index: LineIndex, lines: DataFrame, id_col: str, text_col: str, digest: bool) -> DataFrame:
    held = maybe_repeated(lines, index)
    drops = held.join(index.repeated.select("_key", "_last"), "_key").where(~F.col("_id").eqNullSafe(F.col("_last"))).groupBy(F.col("_id").alias(fresh(docs, "_of"))).agg(F.collect_set("_key").alias(fresh(docs, "_keys")))
    of, keys = drops.columns
    names = docs.columns
    joined = docs.join(drops, docs[id_col].eqNullSafe(drops[of]), "left").select(*[docs[f"`{c}`"] for c in names if c != text_col], docs[text_col].cast("string").alias(text_col), keys)
    at = len(names) - 1
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-1])
    return joined.mapInArrow(_cut(at, keys, index.min_chars, digest), schema + ", n_lines long, n_dropped long, kept_sha256 string" * digest)


def _indexed(docs: DataFrame, index: LineIndex | None, id_col: str, text_col: str, options: dict) -> tuple[LineIndex, DataFrame]:
    """The index to ask (one of these documents where none is given), and their lines."""
    if index is not None:
        return index, line_refs(docs, id_col, text_col, index.min_chars)
    index = build_index(docs, id_col, text_col, **options)
    return index, index.refs


def dedup_report(docs: DataFrame, index: LineIndex | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: id, kept text, number of lines, dropped lines and SHA-256 of what stays."""
    index, lines = _indexed(docs, index, id_col, text_col, options)
    return _resolved(docs.select(id_col, text_col), index, lines, id_col, text_col, True)


def drop_repeated(docs: DataFrame, index: LineIndex | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with repeated lines taken out of their texts, all columns kept."""
    index, lines = _indexed(docs, index, id_col, text_col, options)
    return _resolved(docs, index, lines, id_col, text_col, False).select(*docs.columns)

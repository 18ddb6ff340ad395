"""Clustering of vectors around centroids by Lloyd's rounds over two trees.

Vectors become whole numbers, floor(``SCALE`` * x), so sums, means and squared distances
are exact, and a result does not depend on how the rows are dealt.

* **Cover tree over the vectors**, one for each block of some 1,000 rows, built once. A
  node covers a range of its block's rows, in tree order, from one of them as its centre; its
  children lie within 1 / ``BASE`` of its scale, each centre farther than that from the others. A
  node knows how far its rows really reach. Nodes of few rows, or of equal ones, are leaves.
* **Cover tree over the centroids**, made for each round.
* **Dual traversal.** Starting from both roots, all open pairs of nodes of a step are
  bounded at once: every row of a vector node is at least (distance of the centres - both
  reaches) from each centroid of the other node and at most (distance + both reaches).
  Pairs whose least distance exceeds the smallest greatest distance of their vector node
  are dropped. A node that is left with one centroid gives it all its rows unseen; else the
  wider side of a pair is opened. Leaf pairs are compared exactly, in integers, ties to the
  smaller number. Bounds are kept apart by more than rounding can err.

Plan: a block is an Arrow batch of the scan, so building takes no exchange; blocks (rows in
tree order and the tree) are written once as Parquet. A round is one pass over them that
returns a row of sums for each block and centroid, which Spark adds up; the driver sees the
k * dimension sums of all. Nothing else is collected.

Defined results: rows whose vector is null, has another number of components, or a null or
non-finite one, are left out; a null id is hashed as an empty one; of repeated ids the
smaller vector seeds first; each of repeated rows is clustered; with fewer rows than
centroids there are fewer centroids; an empty table gives an empty result. Components may be
of any size: blocks or centroids beyond ``_SMALL`` are compared in Python's integers, and a
distance or inertia that no long can hold is null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.textvec import small_batches
from citeloom.staging import staged

DIMENSIONS, CENTROIDS, ROUNDS, SEED = 64, 8, 10, 3
SCALE = 1024
#: A child's scale is its parent's over this.
BASE = 1.3
#: Rows of a leaf, at most, unless they are equal.
LEAF = 12
#: Up to this size squared distances of 64 components fit into 64 bits.
_SMALL = 2**27
_LIMB = 40


# --- cover tree


class Tree:
    """Nodes of a cover tree over ``points`` (rows of whole numbers): ranges of ``order``, centres, reaches and children.

    Node 0 is the root; the children of a node are ``first[i]`` .. ``first[i] + kids[i] - 1``.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        x = points.astype(float)
        n = len(x)
        square = (x * x).sum(1)
        far = np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * (x @ x.T), 0))
        order, kids, reach = [], [], []
        todo: list[tuple[np.ndarray, int]] = [(np.arange(n), 0)]
        at = 0
        spans: list[tuple[np.ndarray, int, int]] = []
        while at < len(todo):  # breadth first, so that children stand together
            rows, c = todo[at]
            r = float(far[c, rows].max()) if len(rows) else 0.0
            children: list[tuple[np.ndarray, int]] = []
            if len(rows) > leaf and r > 0:
                scale = BASE ** np.floor(np.log(r) / np.log(BASE))
                while True:  # a scale at which one child would hold all is passed over
                    scale /= BASE
                    left, children, nxt = rows, [], c
                    while len(left):
                        near = far[nxt, left] <= scale
                        near |= left == nxt
                        children.append((left[near], nxt))
                        left = left[~near]
                        if len(left):
                            nxt = int(left[0])
                    if len(children) > 1 or scale < r * 2.0**-40:
                        break
                if len(children) == 1:
                    children = []  # equal but for rounding
            spans.append((rows, c, len(todo) if children else 0))
            kids.append(len(children))
            reach.append(r)
            todo += children
            at += 1
        # leaves in depth-first order give each node a range of rows
        count = len(spans)
        lo, hi = np.zeros(count, np.int64), np.zeros(count, np.int64)
        stack, pos = [(0, False)], 0
        while stack:
            i, done = stack.pop()
            if done:
                hi[i] = pos
                continue
            lo[i] = pos
            if kids[i]:
                stack.append((i, True))
                f = spans[i][2]
                stack += [(j, False) for j in range(f + kids[i] - 1, f - 1, -1)]
            else:
                order.append(spans[i][0])
                pos += len(spans[i][0])
                hi[i] = pos
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        centre, first = [int(place[c]) if n else 0 for _, c, _ in spans], [f for _, _, f in spans]
        # distances come from a difference of large squares: widen by what that can lose
        slack = 1e-6 * float(np.sqrt(square.max())) if n else 0.0
        self.lo, self.hi, self.centre, self.first, self.kids = lo, hi, np.array(centre, np.int64), np.array(first, np.int64), np.array(kids, np.int64)
        self.reach = np.array(reach) + slack

    def packed(self) -> bytes:
        return np.stack([self.lo, self.hi, self.centre, self.first, self.kids, self.reach.view(np.int64)]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        self = cls.__new__(cls)
        self.lo, self.hi, self.centre, self.first, self.kids, reach = np.frombuffer(data, np.int64).reshape(6, -1)
        self.reach = reach.view(float)
        return self


def _opened(count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry its index once for each of ``count``, and first, first + 1, ..."""
    who = np.repeat(np.arange(len(count)), count)
    return who, first[who] + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)


def nearest(points: np.ndarray, tree: Tree, centres: np.ndarray, seen: dict | None = None) -> np.ndarray:
    """The number of the nearest centroid of each point (in tree order), by dual traversal; whole numbers below ``_SMALL``.

    ``seen``, if given, counts the exact comparisons and the rows that were never compared.
    """
    out = np.zeros(len(points), np.int64)
    if not len(points):
        return out
    other = Tree(centres, leaf=1)
    name = other.order  # place in the tree -> number of the centroid
    x, y = points.astype(float), centres[name].astype(float)
    q, r = np.zeros(1, np.int64), np.zeros(1, np.int64)
    pairs_q, pairs_r = [], []
    while len(q):
        d = np.sqrt(((x[tree.centre[q]] - y[other.centre[r]]) ** 2).sum(1))
        both = tree.reach[q] + other.reach[r]
        best = np.full(len(tree.lo), np.inf)
        np.minimum.at(best, q, (d + both) * (1 + 1e-9) + 1e-9)
        keep = d - both <= best[q]
        q, r = q[keep], r[keep]
        size = other.hi[r] - other.lo[r]
        # the candidates of each vector node, and the widest of its open centroid nodes
        held = np.bincount(q, size, len(tree.lo))
        sure = held[q] == 1
        if sure.any():
            for node, c in zip(q[sure], name[other.lo[r[sure]]], strict=True):
                out[tree.lo[node] : tree.hi[node]] = c
            if seen is not None:
                seen["unseen"] = seen.get("unseen", 0) + int((tree.hi - tree.lo)[q[sure]].sum())
            q, r, size = q[~sure], r[~sure], size[~sure]
        wide = np.zeros(len(tree.lo))
        np.maximum.at(wide, q, np.where(other.kids[r] > 0, other.reach[r], -1.0))
        leaf_q, leaf_r = tree.kids[q] == 0, other.kids[r] == 0
        more = np.zeros(len(tree.lo), bool)
        more[q[~leaf_r]] = True  # has centroid nodes to open
        by_r = more[q] & (leaf_q | (wide[q] >= tree.reach[q]))
        ends = leaf_q & ~more[q]
        pairs_q.append(q[ends])
        pairs_r.append(r[ends])
        go_r, stay, go_q = by_r & ~leaf_r, by_r & leaf_r, ~by_r & ~ends
        a, child_r = _opened(other.kids[r[go_r]], other.first[r[go_r]])
        b, child_q = _opened(tree.kids[q[go_q]], tree.first[q[go_q]])
        q, r = np.r_[q[go_r][a], q[stay], child_q], np.r_[child_r, r[stay], r[go_q][b]]
    q, r = np.concatenate(pairs_q), np.concatenate(pairs_r)
    if len(q):  # leaf pairs: each row with each centroid of the leaf, exactly
        a, row = _opened(tree.hi[q] - tree.lo[q], tree.lo[q])
        b, at = _opened((other.hi[r] - other.lo[r])[a], other.lo[r][a])
        row, c = row[b], name[at]
        diff = points[row] - centres[c]
        exact = (diff * diff).sum(1)
        by = np.lexsort((c, exact, row))
        row, c = row[by], c[by]
        lead = np.r_[True, row[1:] != row[:-1]]
        out[row[lead]] = c[lead]
        if seen is not None:
            seen["exact"] = seen.get("exact", 0) + len(by)
    return out


def plainly(points: list[list[int]], centres: list[list[int]]) -> tuple[list[int], list[int]]:
    """Nearest centroids and squared distances in Python's integers, for numbers of any size."""
    got = [min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), i) for i, c in enumerate(centres)) for p in points]
    return [i for _, i in got], [d for d, _ in got]


# --- on Spark


def _whole(vec: str, dimensions: int) -> Column:
    """The vector times ``SCALE`` in doubles, or null if it does not count; tasks floor it, as SQL's floor stops at the range of long."""
    x = F.transform(F.col(vec), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.when((F.size(vec) == dimensions) & fine, F.transform(x, lambda v: v * F.lit(float(SCALE))))


def _blocks(dimensions: int):
    """One row per batch of (_id, _v): ids and whole numbers in tree order, and the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.floor(b.column(1).flatten().to_numpy()).reshape(-1, dimensions)
                tree = Tree(x)
                x, ids = x[tree.order], b.column(0).take(pa.array(tree.order))
                yield pa.RecordBatch.from_pydict({"ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "points": pa.array([x.tobytes()], pa.binary()), "tree": pa.array([tree.packed()], pa.binary())})

    return run


def _assigned(points: bytes, tree: bytes, centres: list[list[int]], dimensions: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Rows of a block as floats, as 64-bit integers where these do, and their centroids."""
    x = np.frombuffer(points, float).reshape(-1, dimensions)
    if np.abs(x).max() < _SMALL and max(max(map(abs, c)) for c in centres) < _SMALL:
        whole = x.astype(np.int64)
        return x, whole, nearest(whole, Tree.unpacked(tree), np.array(centres, np.int64))
    return x, None, np.array(plainly([[int(v) for v in row] for row in x], centres)[0], np.int64)


def _limbs(sums: list[int]) -> list[list[int]]:
    mask = (1 << _LIMB) - 1
    return [[s >> 2 * _LIMB for s in sums], [s >> _LIMB & mask for s in sums], [s & mask for s in sums]]


def _sums(centres: list[list[int]], dimensions: int):
    """Each block's number of rows and componentwise sums of each centroid, in limbs of 40 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for points, tree in zip(b.column("points").to_pylist(), b.column("tree").to_pylist(), strict=True):
                x, whole, near = _assigned(points, tree, centres, dimensions)
                for c in np.unique(near):
                    own = near == c
                    sums = whole[own].sum(0).tolist() if whole is not None else [sum(map(int, column)) for column in x[own].T]
                    out.append((int(c), int(own.sum()), *_limbs(sums)))
            kinds = [pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names=["c", "n", "s2", "s1", "s0"])

    return run


def _final(centres: list[list[int]], dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (points, tree) in enumerate(zip(b.column("points").to_pylist(), b.column("tree").to_pylist(), strict=True)):
                x, whole, near = _assigned(points, tree, centres, dimensions)
                if whole is not None:
                    diff = whole - np.array(centres, np.int64)[near]
                    far = (diff * diff).sum(1).tolist()
                else:
                    far = [sum((int(a) - b) ** 2 for a, b in zip(row, centres[c], strict=True)) for row, c in zip(x, near, strict=True)]
                yield pa.RecordBatch.from_pydict({"_id": b.column("ids")[i].values, "cluster": pa.array(near.astype(np.int32)), "distance": pa.array([d if d < 2**63 else None for d in far], pa.int64())})

    return run


def _collected(sums: DataFrame, centres: list[list[int]], dimensions: int) -> list[list[int]]:
    """New centroids: floored means; those without rows stay."""
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    limbs = sums.select("c", "n", F.posexplode(F.arrays_zip("s2", "s1", "s0")).alias("at", "s")).select("c", "n", "at", "s.*")
    total = {}
    for r in limbs.groupBy("c", "at").agg(F.sum("n").alias("n"), big("s2"), big("s1"), big("s0")).collect():  # k * dimensions rows
        total[r.c, r.at] = (r.n, (int(r.s2) << 2 * _LIMB) + (int(r.s1) << _LIMB) + int(r.s0))
    return [[total[c, i][1] // total[c, i][0] for i in range(dimensions)] if (c, 0) in total else old for c, old in enumerate(centres)]


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """Rows (id, cluster, distance) of the vectors that count, and the final centroids.

    The first centroids are the k vectors whose SHA-256 of "seed:id" is smallest.
    """
    small_batches(vectors)
    rows = vectors.select(F.col(id_col).alias("_id"), _whole(vec_col, dimensions).alias("_v")).where("_v is not null")
    kind = rows.schema["_id"].dataType.simpleString()
    blocks = staged(rows.mapInArrow(_blocks(dimensions), f"ids array<{kind}>, points binary, tree binary"), "cluster-blocks")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    first = rows.select(name.alias("h"), "_v").orderBy("h", "_v").limit(k).collect()
    centres = [[int(np.floor(v)) for v in r._v] for r in first]
    if not centres:
        return blocks.select(F.lit(None).cast(kind).alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centres
    for _ in range(rounds):
        sums = blocks.select("points", "tree").mapInArrow(_sums(centres, dimensions), "c int, n long, s2 array<long>, s1 array<long>, s0 array<long>")
        centres = _collected(sums, centres, dimensions)
    out = blocks.mapInArrow(_final(centres, dimensions), f"_id {kind}, cluster int, distance long")
    return staged(out, "cluster-rows").withColumnRenamed("_id", id_col), centres


def digest(centre: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest()


def cluster_report(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """Rows of ``cluster`` with the inertia of the cluster and of all, and the digest of the centroid."""
    rows, centres = cluster(vectors, id_col, **options)
    spark = vectors.sparkSession
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    by = {r.cluster: r.s for r in rows.groupBy("cluster").agg(whole.alias("s")).collect()}  # k rows
    total = None if None in by.values() else sum(by.values())
    long = lambda v: int(v) if v is not None and v < 2**63 else None
    names = spark.createDataFrame([(c, long(by[c]), long(total), digest(centres[c])) for c in sorted(by)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(names), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

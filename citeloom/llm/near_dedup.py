"""MinHash near-deduplication over TF-IDF shingles.

Method: improved consistent weighted sampling. Texts are cut into shingles of
five words (a shorter text has one of all its words). A shingle weighs its
count in the document times its idf, 1 + ln((1 + N) / (1 + df)) / ln(1 + N),
kept in steps of 1/255 between 1 and 2; df is the exact number of rows that
hold it, N the number of rows. Each of ``bands`` * ``rows`` samples picks a
shingle with probability in proportion to its weight, alike in all documents;
the samples of a band make its key. Documents that share a key of any band are
candidates, and weighted Jaccard similarity of at least ``threshold`` on the
whole weighted shingle sets confirms them. Classes are the connected components
of what is confirmed.

Plan. Documents are dealt into blocks of about ``BLOCK_BYTES`` of text. (1) Each
block sends its distinct shingle hashes, sorted and in delta-coded binary
columns, to ranges of the hash space; a range adds up df and sends back one
answer to each block: a shingle of every document costs one entry per block, and
a row holds the shingles that a block and a range have in common. Blocks and ranges
grow with the root of the input up to eightfold, which keeps rows long up to some
terabytes; beyond, a row tends to one shingle, as in any exchange of shingles. (2) Blocks meet their answers and give each
document's band keys and its idf codes, a byte for each shingle. (3) Of equal
texts one stands for all from here on, named by the digest of its shingles. Inside each band key every document is
compared with the key's smallest document, not with every other one; these
star-shaped links are verified exactly, with leaders salted where many follow
one. In keys that still hold documents of several classes, ``LEADERS`` more documents
from outside the key's largest class are compared in the same way with all of its
documents of other classes. What is left, the pairs of different classes with a member
outside the key's largest class, is compared in full: similar documents have similar
total weights, so only documents of neighbouring weight bands meet, in blocks of about
``BLOCK_DOCS`` documents or ``BLOCK_HASH_BYTES`` of hashes, whichever is less, and a pair
of blocks returns only links that join two classes which it has not joined yet. So no
link inside a key is lost, no task holds a whole key, and no group writes all its pairs.
(4) Components come from alternating large-star and small-star rounds over
staged tables. Ids of candidates are broadcast only while there are at most
``BROADCAST_IDS`` of them.

Defined results: documents are told apart by their content, not by their ids: a node of
the graph is the digest of a text's weighted shingles. Null, empty and wordless texts have no
shingles and are each a class of one row; a row with a null id is compared like any other;
rows of one id with different texts are different documents, each in the class of its
own text; equal texts are always in one class, and rows that repeat both id and text stay or
go together; an empty table gives an empty result; other columns are not read
(``near_classes``) or are kept (``keep_one``). A class is named by its smallest id, nulls
last; its row of that id is kept, of several texts under that id the one with the smallest
digest. So classes of different texts under one id may have one name; ``class_size`` and
``kept`` are always of the class itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.textvec import SLICE_BYTES, mix, shingles, slices, small_batches, word_hashes
from citeloom.operators.components import connected_components
from citeloom.staging import fresh, staged

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 10, 3
BLOCK_BYTES = 4_000_000
BLOCKS_A_TASK = 4
#: Shingles of a range of the hash space, about.
RANGE_SHINGLES = 500_000
#: More documents of a key that all its documents of other classes are compared with.
LEADERS = 4
#: Documents of a block of a key, and bytes of their shingle hashes, about.
BLOCK_DOCS = 1_000
BLOCK_HASH_BYTES = 8_000_000
#: Shingles whose samples are drawn at once, about.
CHUNK_SHINGLES = 20_000
#: Documents that meet one copy of their leader's vector.
FOLLOWERS = 500
BROADCAST_IDS = 4_000_000
_HASH_BITS = 56

_STEPS = 4096


def _gamma_steps() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2: where 1 - (1 + x) exp(-x) is (i + 1/2) / _STEPS, by bisection."""
    want, lo, hi = (np.arange(_STEPS) + 0.5) / _STEPS, np.zeros(_STEPS), np.full(_STEPS, 60.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        low = 1 - (1 + mid) * np.exp(-mid) < want
        lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
    return lo


_RNG = np.random.default_rng(77)
# tables small enough to stay in a core's cache; a hash picks an entry of each
_R = _gamma_steps().astype(np.float32)
_LOG_C = np.log(_gamma_steps()).astype(np.float32)
_BETA = ((np.arange(_STEPS) + 0.5) / _STEPS).astype(np.float32)
_INV_R = (1 / _R).astype(np.float32)
_MUL = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def doc_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, their counts, and document offsets (n + 1)."""
    parts, counts, sizes = [], [], []
    for lo, hi in slices(texts, SLICE_BYTES):
        h, offs = shingles(*word_hashes(texts.slice(lo, hi - lo)), WIDTH)
        h >>= np.uint64(64 - _HASH_BITS)
        for i in range(hi - lo):
            own = np.sort(h[offs[i] : offs[i + 1]])
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            parts.append(own[first])
            counts.append(np.diff(np.r_[first, len(own)]))
            sizes.append(len(first))
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *parts]), np.concatenate([none, *counts]).astype(np.float32), np.r_[0, np.cumsum(sizes, dtype=np.int64)]


def pack(sorted_hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte by byte of equal rank: high bytes are zeros and compress."""
    return np.diff(sorted_hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel(), dtype=np.uint64)


def _text(table: pa.Table, name: str) -> pa.Array:
    col = table.column(name).combine_chunks()
    return col if isinstance(col, pa.Array) else pa.concat_arrays(col.chunks)


def _send(ranges: int):
    """A block's distinct shingles and in how many of its rows each is, by range."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        h, _, _ = doc_shingles(_text(table, "_text"))
        own, df = np.unique(h, return_counts=True)
        at = (own * np.uint64(ranges)) >> np.uint64(_HASH_BITS) if ranges < 256 else (own >> np.uint64(24)) * np.uint64(ranges) >> np.uint64(_HASH_BITS - 24)
        cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(own) else np.zeros(0, np.int64)
        end = np.r_[cut[1:], len(own)] if len(own) else cut
        return pa.table(
            {
                "_block": pa.array(np.full(len(cut), key[0].as_py(), np.int64)),
                "_range": pa.array(at[cut].astype(np.int64)),
                "hashes": pa.array([pack(own[i:j]) for i, j in zip(cut, end, strict=True)], pa.binary()),
                "df": pa.array([df[i:j].astype(np.int32).tobytes() for i, j in zip(cut, end, strict=True)], pa.binary()),
            }
        )

    return run


def _answer(n_rows: int):
    """The idf codes of what each block sent to one range."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        sent = [unpack(x) for x in table.column("hashes").to_pylist()]
        df = np.concatenate([np.frombuffer(x, np.int32) for x in table.column("df").to_pylist()])
        _, where = np.unique(np.concatenate(sent), return_inverse=True)
        codes = idf_codes(np.bincount(where, df), n_rows)[where]
        cut = np.cumsum([0, *map(len, sent)])
        return pa.table(
            {"_block": table.column("_block"), "_range": table.column("_range"), "codes": pa.array([codes[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())}
        )

    return run


def idf_codes(df: np.ndarray, n_rows: int) -> np.ndarray:
    top = np.log1p(max(1, n_rows))
    return np.clip(np.rint(255 * (top - np.log1p(df)) / top), 0, 255).astype(np.uint8)


def weights(codes: np.ndarray, tf: np.ndarray) -> np.ndarray:
    return tf * (1 + codes.astype(np.float32) / np.float32(255))


def signatures(h: np.ndarray, w: np.ndarray, offs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys of the documents that have shingles, a row for each (others are rows of zeros)."""
    n = np.diff(offs)
    full = np.flatnonzero(n)
    out = np.zeros((len(n), bands), np.uint64)
    if not len(full):
        return out
    first, count = offs[:-1][full], n[full]
    log_w = np.log(w)
    mixed = mix(h)
    for band in range(bands):
        key = np.full(len(full), band + 1, np.uint64)
        for row in range(rows):
            bits = mix(mixed * _MUL[band * rows + row]).view(np.int64)
            i, j, k = bits & (_STEPS - 1), (bits >> 16) & (_STEPS - 1), (bits >> 32) & (_STEPS - 1)
            r = _R[i]
            t = np.floor(log_w * _INV_R[i] + _BETA[k])
            a = _LOG_C[j] - r * (t - _BETA[k] + 1)
            least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, first), count))
            at = least[np.searchsorted(least, first)]
            key = mix(key * np.uint64(31) + mixed[at] + t[at].astype(np.int64).view(np.uint64))
        out[full, band] = key
    return out


_SIG = "_id {0}, _sum binary, _same binary, _keys array<long>, _codes binary"


def _sign(bands: int, rows: int):
    """Each document's band keys and idf codes, from a block's texts and its answers."""

    def run(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        order = np.argsort(np.array(answers.column("_range").to_pylist(), np.int64))
        got = answers.column("codes").to_pylist()
        codes = np.frombuffer(b"".join(got[i] for i in order), np.uint8)
        h, tf, offs = doc_shingles(_text(table, "_text"))
        codes = codes[np.searchsorted(np.unique(h), h)] if len(h) else codes
        w, keys = weights(codes, tf), np.zeros((table.num_rows, bands), np.uint64)
        lo = 0
        while lo < table.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + CHUNK_SHINGLES, "right")) - 1)
            a, b = offs[lo], offs[hi]
            keys[lo:hi] = signatures(h[a:b], w[a:b], offs[lo : hi + 1] - a, bands, rows)
            lo = hi
        keys = keys.view(np.int64)
        has = np.diff(offs) > 0
        # equal sets of shingles and counts are equal texts for this operator
        v = mix(h * _MUL[250] + tf.astype(np.uint64) * _MUL[251])
        same = [np.add.reduceat(mix(v * _MUL[252 + i]), offs[:-1][has]) if has.any() else v for i in range(2)]
        sames = iter(np.stack(same, 1)) if has.any() else iter(())
        return pa.table(
            {
                "_id": table.column("_id"),
                "_sum": table.column("_sum"),
                "_same": pa.array([next(sames).tobytes() if x else None for x in has], pa.binary()),
                "_keys": pa.array([k if x else [] for k, x in zip(keys.tolist(), has, strict=True)], pa.list_(pa.int64())),
                "_codes": pa.array([codes[i:j].tobytes() for i, j in zip(offs[:-1], offs[1:], strict=True)], pa.binary()),
            }
        )

    return run


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def sign(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Staged table of (_id, _sum, _same, _keys, _codes) for all rows of docs (_id, _text); ``_sum`` is a digest of the text."""
    small_batches(docs)
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)).alias("b")).first()
    grow = min(8.0, max(1.0, (size.b / 30e9) ** 0.5))
    blocks, ranges = max(1, int(-(-size.b // (grow * BLOCK_BYTES)))), max(1, int(-(-size.b // (6 * grow * RANGE_SHINGLES))))
    kind = docs.schema["_id"].dataType.simpleString()
    dealt = docs.select(F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(blocks)).alias("_block"), "_id", "_text", _digest("_text").alias("_sum"))
    dealt = dealt.repartition(-(-blocks // BLOCKS_A_TASK), "_block")  # tasks grow with the input, whatever the session's number of partitions
    sent = dealt.groupBy("_block").applyInArrow(_send(ranges), "_block long, _range long, hashes binary, df binary")
    back = sent.groupBy("_range").applyInArrow(_answer(size.n), "_block long, _range long, codes binary")
    signed = dealt.groupBy("_block").cogroup(back.groupBy("_block")).applyInArrow(_sign(bands, rows), _SIG.format(kind))
    return staged(signed, "near-signatures")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted shingle sets of documents from text and idf codes."""
    for batch in batches:
        for lo, hi in slices(batch.column(1)):
            b = batch.slice(lo, hi - lo)
            h, tf, offs = doc_shingles(b.column(1))
            codes = b.column(2).to_pylist()
            hs, ws, tops = [], [], []
            fits = np.array([len(c) for c in codes], np.int64) == np.diff(offs)  # else of another text with this id
            b = b.filter(pa.array(fits))
            for i, (x, y) in enumerate(zip(offs[:-1], offs[1:], strict=True)):
                if not fits[i]:
                    continue
                hs.append(h[x:y].tobytes())
                w = weights(np.frombuffer(codes[i], np.uint8), tf[x:y])
                ws.append(w.tobytes())
                tops.append(float(w.sum(dtype=np.float64)))
            yield pa.RecordBatch.from_pydict({"_id": b.column(0), "_h": pa.array(hs, pa.binary()), "_w": pa.array(ws, pa.binary()), "_top": pa.array(tops, pa.float64())})


def similarity(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted weighted sets."""
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    low = float(np.minimum(wa[i], wb[j]).sum(dtype=np.float64))
    return low / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - low)


def _vec(h: bytes, w: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(h, np.uint64), np.frombuffer(w, np.float32)


def _verify(threshold: float):
    """Which pairs (_id, _lead) with both vectors are similar enough; the text of a leader is decoded once in a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [similarity(*_vec(h, w), *_vec(g, v)) >= threshold for h, w, g, v in zip(*(b.column(c).to_pylist() for c in ("_h", "_w", "_lh", "_lw")), strict=True)]
            yield pa.RecordBatch.from_pydict({"_id": b.column("_id"), "_lead": b.column("_lead"), "_ok": pa.array(ok, pa.bool_())})

    return run


def _rest(threshold: float):
    """Links between a block of documents outside a key's largest class and a block of the key's documents: a forest over their classes."""

    def run(key: tuple, few: pa.Table, many: pa.Table) -> pa.Table:
        a = [(i, c, *_vec(h, w)) for i, c, h, w in zip(*(few.column(x).to_pylist() for x in ("_id", "_c", "_h", "_w")), strict=True)]
        out, kind = [], few.schema.field("_id").type
        if a:
            names = np.unique(np.concatenate([x[2] for x in a]))
            tops = np.array([x[3].sum(dtype=np.float64) for x in a])
            held = np.concatenate([np.searchsorted(names, x[2]) for x in a])
            whose = np.repeat(np.arange(len(a)), [len(x[2]) for x in a])
            value = np.concatenate([x[3] for x in a])
            order = np.argsort(held, kind="stable")
            held, whose, value = held[order], whose[order], value[order]
            start = np.searchsorted(held, np.arange(len(names) + 1))
            joined: dict = {}

            def root(c):
                while c in joined:
                    c = joined[c]
                return c

            for i, c, h, w in zip(*(many.column(x).to_pylist() for x in ("_id", "_c", "_h", "_w")), strict=True):
                h, w = _vec(h, w)
                at = np.minimum(np.searchsorted(names, h), len(names) - 1)
                hit = np.flatnonzero(names[at] == h)
                lo, n = start[at[hit]], start[at[hit] + 1] - start[at[hit]]
                pos = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                low = np.bincount(whose[pos], np.minimum(value[pos], np.repeat(w[hit], n)), len(a))
                found = np.flatnonzero(low >= threshold * (tops + w.sum(dtype=np.float64) - low))
                for k in found.tolist():
                    x, y = root(a[k][1]), root(c)
                    if x != y:
                        joined[x] = y
                        out.append((a[k][0], i))
        return pa.table({"_a": pa.array([x for x, _ in out], kind), "_b": pa.array([x for _, x in out], kind)})

    return run


def _confirmed(pairs: DataFrame, vectors: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Those of the pairs (_id, _lead) that are similar enough; a leader's vector is copied for every ``FOLLOWERS`` of its pairs."""
    pairs = staged(pairs, "near-pairs")
    salts = staged(pairs.groupBy("_lead").agg((F.floor(F.count(F.lit(1)) / FOLLOWERS) + 1).alias("_salts")), "near-salts")
    led = vectors.join(salts, F.col("_id") == F.col("_lead")).select("_lead", F.col("_h").alias("_lh"), F.col("_w").alias("_lw"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)).alias("_salt"))
    salted = pairs.join(salts, "_lead").select("_id", "_lead", F.pmod(F.xxhash64("_id"), F.col("_salts")).alias("_salt"))
    both = salted.join(vectors, "_id").join(led, ["_lead", "_salt"]).select("_id", "_lead", "_h", "_w", "_lh", "_lw")
    checked = staged(both.mapInArrow(_verify(threshold), f"_id {kind}, _lead {kind}, _ok boolean").where("_ok"), "near-checked")
    return checked.select(F.col("_id").alias("_a"), F.col("_lead").alias("_b"))


def _joined(classes: DataFrame, more: DataFrame) -> DataFrame:
    """The classes (node, component) after more links (_a, _b)."""
    if more.isEmpty():
        return classes
    return connected_components(classes.where("node <> component").toDF("_a", "_b").unionByName(more), "_a", "_b")


def _mixed(member: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of keys with documents of several classes all documents with their class, and those outside the key's largest class."""
    named = member.join(classes.select(F.col("node").alias("_id"), F.col("component").alias("_got")), "_id", "left").select("_key", "_lead", "_id", F.coalesce("_got", "_id").alias("_c"))
    held = named.groupBy("_key", "_c").agg(F.count(F.lit(1)).alias("_n")).groupBy("_key").agg(F.count(F.lit(1)).alias("_k"), F.max_by("_c", "_n").alias("_most")).where("_k > 1").select("_key", "_most")
    mixed = staged(named.join(staged(held, "near-most"), "_key"), "near-mixed")
    return mixed, mixed.where("_c <> _most")


def _more_stars(mixed: DataFrame, few: DataFrame, vectors: DataFrame, threshold: float, kind: str) -> tuple[DataFrame, DataFrame]:
    """Links of more leaders of each key with the key's documents of other classes; and the members of keys that have more than these."""
    few = few.where("_id <> _lead")  # every document has met the first leader
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64("_id", F.lit(9)), "_id"))
    lead = staged(few.withColumn("_nth", nth).where(F.col("_nth") <= LEADERS).select("_key", F.col("_id").alias("_new"), F.col("_c").alias("_nc")), "near-leaders")
    also = lead.select("_key", F.col("_new").alias("_id"), F.lit(True).alias("_led"))
    met = mixed.where("_id <> _lead").join(also, ["_key", "_id"], "left")
    pairs = met.join(lead, "_key").where("_c <> _nc and (_led is null or _id < _new)").select("_id", F.col("_new").alias("_lead")).distinct()
    large = staged(few.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LEADERS).select("_key"), "near-large")
    return _confirmed(pairs, vectors, threshold, kind), mixed.select("_key", "_lead", "_id").join(large, "_key")


def _compared(named: DataFrame, few: DataFrame, vectors: DataFrame, threshold: float, kind: str) -> DataFrame:
    """Links of all pairs of different classes inside a key, each class pair of a pair of blocks once."""
    band = F.floor(F.log("_top") / (-1.001 * np.log(threshold))).alias("_band")
    light = vectors.select("_id", band, F.octet_length("_h").alias("_len"))
    parts = (F.floor(F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("_len") / BLOCK_HASH_BYTES)) + 1).alias("_parts")
    many = named.join(light, "_id").select("_key", "_band", "_id", "_c", "_len")
    near = F.explode(F.array(*[F.col("_band") + i for i in (-1, 0, 1)])).alias("_band")
    few = few.join(light, "_id").select("_key", near, "_id", "_c", "_len")
    split = few.groupBy("_key", "_band").agg(parts).withColumnRenamed("_parts", "_fb").join(many.groupBy("_key", "_band").agg(parts).withColumnRenamed("_parts", "_mb"), ["_key", "_band"])
    split = staged(split, "near-split")
    deal = lambda n, seed: F.pmod(F.xxhash64("_id", F.lit(seed)), n)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    on = ["_key", "_band"]
    vec = vectors.select("_id", "_h", "_w")
    few = few.join(split, on).withColumn("_i", deal(F.col("_fb"), 1)).withColumn("_j", each("_mb")).select(*on, "_i", "_j", "_id", "_c").join(vec, "_id")
    many = many.join(split, on).withColumn("_j", deal(F.col("_mb"), 2)).withColumn("_i", each("_fb")).select(*on, "_i", "_j", "_id", "_c").join(vec, "_id")
    few = few.select(*[F.col(c).alias(c) for c in few.columns])  # new column ids: both sides come from the same tables
    many = many.select(*[F.col(c).alias(c) for c in many.columns])
    at = [*on, "_i", "_j"]
    return staged(few.groupBy(*at).cogroup(many.groupBy(*at)).applyInArrow(_rest(threshold), f"_a {kind}, _b {kind}").distinct(), "near-more")


def _node(id_: Column, kind: str, same: Column) -> Column:
    """The name of a content: the bytes of its smallest id, in the order of ids, then its digest; null ids come last.

    The digest makes it unique; the id makes links point at the smallest ids, as different bands then agree on a star's centre.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        first = F.unhex(F.lpad(F.hex(id_.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0"))
    else:
        first = F.encode(id_.cast("string"), "UTF-8")
    return F.concat(F.coalesce(first, F.unhex(F.lit("FF" * 8))), same)


def _classes(docs: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per input row: _id, _sum, class_id, class_size and kept."""
    rows_in = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    signed = sign(rows_in, bands, rows)
    kind = "binary"
    id_kind = rows_in.schema["_id"].dataType.simpleString()
    row = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_sum").alias("sum"))

    # a document is its content from here on: one row stands for all of equal shingles, none for those without
    stands = signed.where("_same is not null").groupBy("_same").agg(F.min(row).alias("_row"), F.any_value("_keys").alias("_keys"), F.any_value("_codes").alias("_codes"))
    stands = staged(stands.withColumn("_node", _node(F.col("_row.id"), id_kind, F.col("_same"))), "near-texts")
    member = stands.select(F.col("_node").alias("_id"), F.explode("_keys").alias("_key"))
    # staged, so that the joins below read plain exchanges on both sides and AQE can split a hot key
    shared = staged(member.groupBy("_key").agg(F.min("_id").alias("_lead"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key", "_lead"), "near-keys")
    member = staged(member.join(shared, "_key"), "near-members")

    pairs = member.where("_id <> _lead").select("_id", "_lead").distinct()
    ids = member.select("_id").distinct()
    some = staged(stands.join(ids, stands["_node"] == ids["_id"], "left_semi").select("_node", F.col("_row.id").alias("_of"), F.col("_row.sum").alias("_own"), "_codes"), "near-candidates")
    few = some.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    place = some.select("_node", "_of", "_own")
    texts = rows_in.withColumn("_sum", _digest("_text"))
    texts = texts.join(F.broadcast(place) if few else place, texts["_id"].eqNullSafe(F.col("_of")) & (texts["_sum"] == F.col("_own")))
    vectors = texts.join(some.select("_node", "_codes"), "_node").select(F.col("_node").alias("_id"), "_text", "_codes")
    vectors = staged(vectors.mapInArrow(_vectors, "_id binary, _h binary, _w binary, _top double").dropDuplicates(["_id"]), "near-vectors")

    first = connected_components(_confirmed(pairs, vectors, threshold, kind), "_a", "_b")
    mixed, few = _mixed(member, first)
    if not few.isEmpty():
        more, member = _more_stars(mixed, few, vectors, threshold, kind)
        first = _joined(first, more)
        mixed, few = _mixed(member, first)
        if not few.isEmpty():
            first = _joined(first, _compared(mixed, few, vectors, threshold, kind))

    of = stands.select("_same", "_node").join(first.select(F.col("node").alias("_node"), "component"), "_node").select("_same", "component")
    classed = staged(signed.select("_id", "_sum", "_same").join(of, "_same", "left").select("_id", "_sum", F.coalesce("component", "_same").alias("_class")), "near-classes")
    named = classed.where("_class is not null").groupBy("_class").agg(F.count(F.lit(1)).alias("class_size"), F.min(row).alias("_row"))
    out = classed.join(named, "_class", "left")
    own = F.col("_id").eqNullSafe(F.col("_row.id")) & (F.col("_sum") == F.col("_row.sum"))
    alone = F.col("_class").isNull()
    return out.select(
        "_id", "_sum", F.when(alone, F.col("_id")).otherwise(F.col("_row.id")).alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), (alone | own).alias("kept")
    )


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: id, class_id, class_size and kept (the row that stands for its class)."""
    return _classes(docs, id_col, text_col, **options).drop("_sum").withColumnRenamed("_id", id_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, all columns, that stand for their class; each row is judged by its id and its own text."""
    of, own = fresh(docs, "_of"), fresh(docs, "_sum")
    gone = _classes(docs, id_col, text_col, **options).where(~F.col("kept")).select(F.col("_id").alias(of), F.col("_sum").alias(own)).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone[of]) & (_digest(text_col) == gone[own]), "left_anti")

"""Stored indexes: words with block maxima, and vectors in cells.

``WordIndex`` keeps postings as Parquet, a folder for each segment and bucket of
terms. A posting list is cut into blocks by weight and by a hash of the document, so a word that
very many texts hold is many rows; each block knows its largest frequency and shortest
text, which bound what its documents can score. A question reads the buckets of its
words and leaves out every block that cannot reach the best ones. New texts are a new segment;
``merge`` makes one of all.

``VectorIndex`` has cells fitted on a bounded sample, to which every row is dealt;
queries visit their nearest cells, in a grid of blocks of rows and of queries.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.functions.scalar import blank, query_terms
from citeloom.operators.analytics import knn, ranked
from citeloom.staging import staged

#: Documents of a posting block, about, buckets of terms, and steps of a posting's weight that blocks keep apart.
BLOCK, BUCKETS, GRADES = 1_000, 64, 8


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(blank(text)), r"(?U)[^\p{L}\p{N}]+"), lambda w: w != "")


class WordIndex:
    """QRY26: an inverted index of texts in a shared folder."""

    def __init__(self, spark: SparkSession, path: str, k1: float = 1.2, b: float = 0.75):
        self.spark, self.path, self.k1, self.b = spark, path.rstrip("/"), k1, b

    # --- writing

    def _write(self, postings: DataFrame, total: DataFrame, segment: str) -> None:
        """Postings (id, term, tf, length) and the segment's (total, words)."""
        # postings of like weight stand together, so that a block's bound is near to what each of its texts scores
        mean = total.select((F.col("words") / F.greatest(F.col("total"), F.lit(1))).alias("m")).first().m or 1.0
        grade = F.floor(self._weight(F.col("tf"), F.col("length"), max(mean, 1e-9)) * GRADES / (self.k1 + 1)).alias("grade")
        graded = postings.select("*", grade)
        often = graded.groupBy("term", "grade").agg(F.count(F.lit(1)).alias("df"))
        cut = (F.col("grade") * 2**32 + F.pmod(F.xxhash64("id"), F.floor(F.col("df") / BLOCK) + 1)).cast("long").alias("block")
        rows = graded.join(often, ["term", "grade"]).select("term", cut, F.struct("id", "tf", "length").alias("p"))
        blocks = rows.groupBy("term", "block").agg(F.count(F.lit(1)).alias("n"), F.max("p.tf").alias("max_tf"), F.min("p.length").alias("min_length"), F.sort_array(F.collect_list("p")).alias("postings"))
        blocks = blocks.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(BUCKETS)))
        # a bucket is written by a few tasks, in the order of its terms, so that a file's statistics tell where a term is
        blocks = blocks.repartition("bucket", F.pmod(F.xxhash64("term"), F.lit(7))).sortWithinPartitions("bucket", "term", "block")
        blocks.write.partitionBy("bucket").parquet(f"{self.path}/postings/segment={segment}")
        total.write.parquet(f"{self.path}/totals/segment={segment}")  # last: a segment without totals is not read

    def add(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        """Index more texts as a new segment; null and blank texts count as texts without words."""
        d = docs.select(F.col(id_col).alias("id"), _words(text_col).alias("w")).withColumn("length", F.size("w").cast("long"))
        postings = d.select("id", "length", F.explode("w").alias("term")).groupBy("id", "length", "term").agg(F.count(F.lit(1)).alias("tf"))
        self._write(staged(postings, "index-postings"), d.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum("length"), F.lit(0)).alias("words")), uuid.uuid4().hex)

    def merge(self, into: str) -> WordIndex:
        """One segment of all, as an index of its own in the folder ``into``; readers of this one are not disturbed."""
        p = self._postings().select("term", F.explode("postings").alias("p")).select("term", "p.*")
        out = WordIndex(self.spark, into, self.k1, self.b)
        out._write(p, self._totals().agg(F.sum("total").alias("total"), F.sum("words").alias("words")), uuid.uuid4().hex)
        return out

    # --- reading

    def _totals(self) -> DataFrame:
        return self.spark.read.schema("total long, words long, segment string").parquet(f"{self.path}/totals")

    def _postings(self) -> DataFrame:
        segments = [r.segment for r in self._totals().select("segment").distinct().collect()]  # one row for each segment
        return self.spark.read.parquet(f"{self.path}/postings").where(F.col("segment").isin(segments))

    def selected(self, question: str) -> tuple[DataFrame, list[str]]:
        """The blocks of a question's words; only their buckets' folders are read."""
        asked = self.spark.range(1).select(F.explode(F.array_distinct(query_terms(F.lit(question)))).alias("t")).select("t", F.pmod(F.xxhash64("t"), F.lit(BUCKETS)).alias("b")).collect()
        terms = sorted(r.t for r in asked)
        return self._postings().where(F.col("bucket").isin(sorted({int(r.b) for r in asked})) & F.col("term").isin(terms)), terms

    def _weight(self, tf: Column, length: Column, average: float) -> Column:
        return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length / F.lit(average)))

    def _scored(self, blocks: DataFrame, idf: Column, average: float) -> DataFrame:
        p = blocks.select("term", F.explode("postings").alias("p")).select("term", "p.*")
        return p.groupBy("id").agg(F.sum(idf * self._weight(F.col("tf"), F.col("length"), average)).alias("_s"))

    def kept(self, question: str, k: int) -> tuple[DataFrame, Column, float] | None:
        """The blocks that may hold one of the best k texts, the weight of a row's word, and the mean length of texts.

        What the k-th best text scores in each word's most promising block alone is a lower bound of the k-th best
        score; a block whose bound, with those of the other words, stays below it is left out.
        """
        blocks, terms = self.selected(question)
        all_ = self._totals().agg(F.sum("total").alias("n"), F.sum("words").alias("w")).first()
        if not terms or not all_.n or not all_.w:
            return None
        average = all_.w / all_.n
        bound = self._weight(F.col("max_tf"), F.col("min_length"), average)
        facts = blocks.groupBy("term").agg(F.sum("n").alias("df"), F.max(bound).alias("top"), F.max_by(F.struct("segment", "block"), bound).alias("at")).collect()  # a row for each word
        if not facts:
            return None
        weight = {r.term: float(np.log(1 + (all_.n - r.df + 0.5) / (r.df + 0.5))) for r in facts}
        idf = F.create_map(*[F.lit(x) for t, w in sorted(weight.items()) for x in (t, w)])[F.col("term")]
        best = None
        for r in facts:
            one = (F.col("term") == r.term) & (F.col("segment") == r["at"]["segment"]) & (F.col("block") == r["at"]["block"])
            best = one if best is None else best | one
        lead = [r._s for r in self._scored(blocks.where(best), idf, average).orderBy(F.desc("_s")).limit(k).collect()]
        least = lead[-1] if len(lead) == k else 0.0
        sum_ = sum(weight[r.term] * r.top for r in facts)
        rest = F.create_map(*[F.lit(x) for r in facts for x in (r.term, sum_ - weight[r.term] * r.top)])[F.col("term")]
        return blocks.where(idf * bound + rest >= F.lit(least - 1e-5)), idf, average

    def search(self, question: str, k: int) -> DataFrame:
        """(id, score, rank) of the best k texts by BM25; equal to scoring all texts."""
        found = self.kept(question, k)
        if found is None:
            return ranked(self._postings().select(F.get("postings", 0)["id"].alias("id"), F.lit(0.0).alias("score")).limit(0), [F.desc("score"), F.asc("id")], k)
        return ranked(self._scored(*found).select("id", F.round("_s", 6).alias("score")), [F.desc("score"), F.asc("id")], k)


# --- vectors

#: Rows that cells are fitted on, at most (lowest hash of the id), and cells.
SAMPLE, CELLS = 20_000, 1_024
#: Rows and queries of a block of the grid, about.
ROWS_A_BLOCK, QUERIES_A_BLOCK = 20_000, 2_000


def _unit(v: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(v / np.linalg.norm(v, axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    a = pa.concat_arrays(a.chunks) if isinstance(a, pa.ChunkedArray) else a
    return a.flatten().to_numpy().astype(np.float64).reshape(len(a), -1) if len(a) else np.zeros((0, 0))


class VectorIndex:
    """QRY25: cosine neighbours through cells; rows without a vector, or of another length than most of the sample, are left out."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cells: int | None = None, rounds: int = 10):
        self.spark = vectors.sparkSession
        v = vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        v = v.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x)))
        head = v.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
        sizes = np.array([len(x) for x in head["v"].to_pylist()] or [0])
        self.size = int(np.bincount(sizes).argmax())
        sample = _unit(_matrix(head.filter(pa.array(sizes == self.size))["v"])) if head.num_rows else np.zeros((0, 0))
        total = v.count()
        k = min(len(sample), cells or min(CELLS, max(1, int(total**0.5))))
        self.centres = sample[:: max(1, len(sample) // k)][:k] if k else sample
        for _ in range(rounds):
            near = (sample @ self.centres.T).argmax(1) if k else np.zeros(0, np.int64)
            for c in range(k):
                if (near == c).any():
                    self.centres[c] = sample[near == c].mean(0)
            self.centres = _unit(self.centres) if k else self.centres
        self.probes: int | None = None
        self.rows = staged(self._dealt(v.where(F.size("v") == self.size), 1).drop("nth"), "vector-cells")

    def _dealt(self, v: DataFrame, probes: int) -> DataFrame:
        """Each row with its nearest cells."""
        sent = self.spark.sparkContext.broadcast(self.centres)  # at most CELLS vectors

        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                score = _unit(_matrix(b.column(1))) @ sent.value.T
                n = min(probes, score.shape[1])
                top = np.argsort(-score, axis=1, kind="stable")[:, :n]
                at = pa.array(np.repeat(np.arange(b.num_rows), n))
                yield pa.RecordBatch.from_pydict({"id": b.column(0).take(at), "v": b.column(1).take(at), "cell": pa.array(top.ravel().astype(np.int64)), "nth": pa.array(np.tile(np.arange(n), b.num_rows).astype(np.int64))})

        return v.mapInArrow(run, "id long, v array<double>, cell long, nth long")

    def probes_for(self, want: float = 0.95, k: int = 10, asked: int = 64) -> int:
        """How many cells a query must visit to find the share ``want`` of its neighbours, measured on ``asked`` rows against all rows."""
        head = self.rows.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(asked).select(F.col("id").alias("vec_id"), F.col("v").alias("embedding"))
        head = staged(head, "vector-asked")
        exact = knn(self.rows.select(F.col("id").alias("vec_id"), F.col("v").alias("embedding")), head, k)
        found = exact.join(self.rows.select("id", "cell"), "id").join(head.withColumnRenamed("vec_id", "q"), "q").select("embedding", "cell").toArrow()  # asked * k rows
        if not found.num_rows:
            return 1
        score = _unit(_matrix(found["embedding"])) @ self.centres.T
        own = score[np.arange(len(score)), found["cell"].to_numpy()]
        before = np.sort((score > own[:, None]).sum(1))
        return int(before[min(len(before) - 1, int(np.ceil(want * len(before))))]) + 1

    def search(self, queries: DataFrame, k: int, probes: int | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
        """(q, id, score, rank) of the k nearest rows of each query among its ``probes`` nearest cells, itself left out; one job.

        Without ``probes`` the number is measured once (``probes_for``): vectors without clusters need many.
        """
        if probes is None:
            self.probes = probes = self.probes or self.probes_for(k=k)
        q = queries.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.size("v") == self.size)
        asked = staged(self._dealt(q, probes).select("id", "v", "cell"), "vector-queries")
        blocks = lambda df, n, name: df.groupBy("cell").agg((F.floor(F.count(F.lit(1)) / n) + 1).alias(name))
        grid = F.broadcast(blocks(self.rows, ROWS_A_BLOCK, "ni").join(blocks(asked, QUERIES_A_BLOCK, "nj"), "cell"))  # at most a row for each cell
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        left = self.rows.join(grid, "cell").withColumn("i", F.pmod(F.xxhash64("id"), F.col("ni"))).withColumn("j", each("nj")).select("cell", "i", "j", "id", "v")
        right = asked.join(grid, "cell").withColumn("j", F.pmod(F.xxhash64("id", F.lit(3)), F.col("nj"))).withColumn("i", each("ni")).select("cell", "i", "j", "id", "v")

        def best(key, rows: pa.Table, some: pa.Table) -> pa.Table:
            out_q, out_id, out_s = [], [], []
            if rows.num_rows and some.num_rows:
                own, ask = rows["id"].to_numpy(), some["id"].to_numpy()
                score = np.round(_unit(_matrix(some["v"])) @ _unit(_matrix(rows["v"])).T, 6)
                for i, s in enumerate(score):
                    s = np.where(own == ask[i], -np.inf, s)
                    cut = np.partition(-s, k - 1)[k - 1] if len(s) > k else np.inf
                    for x in sorted(zip((-s[-s <= cut]).tolist(), own[-s <= cut].tolist(), strict=True))[:k]:
                        if np.isfinite(x[0]):
                            out_q.append(ask[i])
                            out_id.append(x[1])
                            out_s.append(-x[0])
            return pa.table({"q": pa.array(out_q, pa.int64()), "id": pa.array(out_id, pa.int64()), "score": pa.array(out_s, pa.float64())})

        at = ["cell", "i", "j"]
        found = left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(best, "q long, id long, score double").dropDuplicates(["q", "id"])
        return found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Of each query, the share of its exact neighbours that were found: their mean, and the number of queries."""
    hit = exact.select("q", "id").join(found.select("q", "id").withColumn("_f", F.lit(1)), ["q", "id"], "left").groupBy("q").agg((F.sum(F.coalesce("_f", F.lit(0))) / F.count(F.lit(1))).alias("r"))
    return hit.agg(F.avg("r").alias("recall"), F.count(F.lit(1)).alias("queries"))

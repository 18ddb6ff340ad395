"""Coverage reports, the analytical questions and search, over result tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.functions.scalar import blank, dd_bucket, decade, query_terms, spread, title_key
from citeloom.staging import staged

# Statuses of arbitration by the group they are reported in.
GROUPS = {"counted": "counted", "rejected_row": "rejected", "self_citation_row": "self", "cross_boundary_invalid": "superseded", "year_reread_as_vol_invalid": "superseded", "span_alternative_undecided": "conflict", "overlap_undecided": "conflict"}
RRF = 60


def arbitration_group(status: Column) -> Column:
    """COV03."""
    out = F.when(blank(status).startswith("alternative_"), "alternative").when(blank(status) == "", "other")
    for k, v in GROUPS.items():
        out = out.when(status == k, v)
    return out.otherwise("other")


def coverage(mentions: DataFrame, by: list[str], position: list[str], source: str = "source_id") -> DataFrame:
    """COV01: rows, distinct positions and distinct sources, for each value of ``by`` and in total (rollup).

    ``position`` names the source first, so one exchange by source is enough: a source's rows are counted by level
    where they lie, and only these counts are added over all sources.
    """
    if source not in position:
        raise ValueError(f"a position is one of a source: {position} lacks {source}")
    place = [c for c in position if c != source]
    upper = [F.struct(F.lit(2**k - 1).cast("long").alias("level"), *[(F.col(c) if i < len(by) - k else F.lit(None).cast(mentions.schema[c].dataType)).alias(c) for i, c in enumerate(by)]) for k in range(len(by) + 1)]
    near = mentions.select(source, *place, *by).repartition(source).groupBy(source, *place, *by).agg(F.count(F.lit(1)).alias("rows"))
    at = near.select(source, *place, "rows", F.explode(F.array(*upper)).alias("_at")).select(source, *place, "rows", "_at.*")
    at = at.groupBy(source, "level", *by, *place).agg(F.sum("rows").alias("rows"))
    at = at.groupBy(source, "level", *by).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("positions"))
    return at.groupBy("level", *by).agg(F.sum("rows").alias("rows"), F.sum("positions").alias("positions"), F.count(source).alias("sources")).select(*by, "rows", "positions", "sources", "level")


def families(rows: DataFrame, table: DataFrame, family: str = "family", source: str = "source_id", form: str = "raw_string") -> DataFrame:
    """COV02: families by distinct sources, with their commonest form and whether the table has them."""
    n = rows.groupBy(family).agg(F.count(F.lit(1)).alias("candidate_rows"), F.count_distinct(source).alias("distinct_sources"))
    top = rows.groupBy(family, form).agg(F.count(F.lit(1)).alias("_n")).groupBy(family).agg(F.min_by(F.col(form), F.struct(-F.col("_n"), F.col(form))).alias("top_form"))
    t = table.select(F.col(family)).distinct().withColumn("_t", F.lit(True))
    return n.join(top, family).join(t, family, "left").select(family, "candidate_rows", "distinct_sources", "top_form", F.when(F.col("_t"), "in_table").otherwise("absent").alias("table_status"))


def ranked(df: DataFrame, order: list[Column], top: int, rank: str = "rank") -> DataFrame:
    """The first rows of a total order with their rank: a top-k that each partition prunes first."""
    best = df.orderBy(*order).limit(top)
    return best.withColumn(rank, F.row_number().over(Window.orderBy(*order)).cast("long"))


def relation_summary(relations: DataFrame) -> DataFrame:
    """COV04: pairs with one relation; a pair with two fails."""
    a = relations.groupBy("source_id", "group_id").agg(F.count_distinct("relation").alias("_n"), F.min("relation").alias("relation"))
    return a.withColumn("relation", F.when(F.col("_n") > 1, F.raise_error(F.lit("pair with two relations")).cast("string")).otherwise(F.col("relation"))).groupBy("relation").agg(F.count(F.lit(1)).alias("pairs"))


@dataclass
class Filters:
    """QRY02."""

    court: str | None = None
    year_from: int | None = None
    year_to: int | None = None
    origin: str | None = None
    min_dd: int | None = None
    group_id: str | None = None
    kept_only: bool = False

    def validate(self) -> Filters:
        if self.year_from is not None and self.year_to is not None and self.year_from > self.year_to:
            raise ValueError("year_from after year_to")
        if self.min_dd is not None and self.min_dd < 1:
            raise ValueError("min_dd below 1")
        return self

    def condition(self, skip: tuple[str, ...] = ()) -> Column:
        tests = {
            "court": ("source_court", lambda c, v: c == v), "year_from": ("source_year", lambda c, v: c >= v), "year_to": ("source_year", lambda c, v: c <= v),
            "origin": ("foreign_status", lambda c, v: c == v), "min_dd": ("dd", lambda c, v: c >= v), "group_id": ("group_id", lambda c, v: c == v),
        }
        out = F.lit(True)
        for name, (c, test) in tests.items():
            value = getattr(self, name)
            if value is not None and name not in skip:
                out = out & F.coalesce(test(F.col(c), value), F.lit(False))
        return out & F.col("kept") if self.kept_only else out


def documents_once(docs: DataFrame) -> DataFrame:
    """QRY04: one row per source; court UNKNOWN and year null where its rows disagree."""
    a = docs.where(blank("source_id") != "").groupBy("source_id").agg(F.count_distinct("court").alias("_c"), F.min("court").alias("court"), F.count_distinct("year").alias("_y"), F.min("year").alias("year"))
    return a.select("source_id", F.when(F.col("_c") == 1, F.col("court")).otherwise("UNKNOWN").alias("source_court"), F.when(F.col("_y") == 1, F.col("year")).alias("source_year"))


def base(edges: DataFrame, groups: DataFrame, docs: DataFrame, filters: Filters | None = None) -> DataFrame:
    """QRY03: edges with their group and their document, filtered before anything is counted."""
    b = edges.join(groups, "group_id").join(documents_once(docs), "source_id", "left")
    b = b.withColumn("source_court", F.coalesce("source_court", F.lit("UNKNOWN"))).withColumn("source_decade", decade("source_year"))
    return b.where((filters or Filters()).validate().condition())


METRICS = ["citation_edges", "cited_groups", "citing_sources", "origin_known", "foreign_edges", "heuristic_edges"]


def metrics(b: DataFrame, by: list[str]) -> DataFrame:
    """QRY05, QRY06: counts, and rates that are null without a denominator."""
    a = b.groupBy(*by).agg(
        F.count(F.lit(1)).alias("citation_edges"), F.count_distinct("group_id").alias("cited_groups"), F.count_distinct("source_id").alias("citing_sources"),
        F.count_if(F.col("foreign_status").isin("DOMESTIC_CA", "FOREIGN")).alias("origin_known"), F.count_if(F.col("foreign_status") == "FOREIGN").alias("foreign_edges"),
        F.count_if(F.col("edge_support") == "heuristic_only").alias("heuristic_edges"),
    )
    return a.withColumn("foreign_share_known", F.round(F.try_divide(F.col("foreign_edges").cast("double"), F.col("origin_known")), 6))


def court_decade(b: DataFrame, docs: DataFrame) -> DataFrame:
    """QRY08, QRY11: court by decade, with the documents that could have cited; zeros where one side has none."""
    e = b.groupBy("source_court", "source_decade").agg(F.count(F.lit(1)).alias("citation_edges"), F.count_distinct("source_id").alias("citing_sources"))
    d = documents_once(docs).withColumn("source_decade", decade("source_year")).groupBy("source_court", "source_decade").agg(F.count(F.lit(1)).alias("documents"))
    e = e.withColumn("source_decade", F.coalesce("source_decade", F.lit(-1)))
    d = d.withColumn("source_decade", F.coalesce("source_decade", F.lit(-1)))
    return e.join(d, ["source_court", "source_decade"], "full_outer").na.fill(0, ["citation_edges", "citing_sources", "documents"])


def ranking(b: DataFrame, top: int, parts: int | None = None) -> DataFrame:
    """QRY09: groups by their distinct sources under the filters; ``parts`` is the number of tasks that tell sources apart."""
    if not 1 <= top <= 100:
        raise ValueError("top must be 1 to 100")
    pairs = b.select("group_id", "source_id")
    pairs = (pairs.repartition(parts, "group_id", "source_id") if parts else pairs).distinct()
    n = pairs.groupBy("group_id").agg(F.count("source_id").alias("filtered_dd"))
    return ranked(n, [F.desc("filtered_dd"), F.asc("group_id")], top)


def case_citations(b: DataFrame, group_id, top: int) -> DataFrame:
    """QRY10: the latest citing documents of one group, and how many there are."""
    own = b.where(F.col("group_id") == group_id).select("source_id", "source_court", "source_year")
    n = own.agg(F.count(F.lit(1)).alias("total"))
    return own.orderBy(F.desc_nulls_last("source_year"), "source_id").limit(top).crossJoin(n).withColumn("truncated", F.col("total") > top)


def name_lookup(groups: DataFrame, contains: str, top: int, name: str = "name") -> DataFrame:
    """QRY12: groups whose name has the words as they are, in any case."""
    hit = groups.where(F.instr(F.lower(blank(name)), contains.lower()) > 0)
    return ranked(hit, [F.desc("dd"), F.asc("group_id")], top)


def evidence_packet(b: DataFrame, mentions: DataFrame, texts: DataFrame, per_edge: int = 1, width: int = 160) -> DataFrame:
    """QRY13: the first mentions of each edge with a window of text and its hash; texts are met only by the documents needed."""
    w = Window.partitionBy("source_id", "group_id").orderBy("match_start_offset", "match_end_offset")
    m = mentions.join(b.select("source_id", "group_id").distinct(), ["source_id", "group_id"], "left_semi").withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= per_edge).drop("_r")
    a = F.greatest(F.col("match_start_offset") - width, F.lit(0))
    j = m.join(texts.select("source_id", "text"), "source_id")
    return j.withColumn("window", F.substring("text", (a + 1).cast("int"), (F.col("match_end_offset") + width - a).cast("int"))).withColumn("text_sha256", F.sha2("text", 256)).drop("text")


ANSWERS = {
    "count": {"en": "{citation_edges} citations of {cited_groups} cases by {citing_sources} documents.", "fr": "{citation_edges} citations de {cited_groups} décisions par {citing_sources} documents."},
    "ranking": {"en": "Most cited: {group_id} with {filtered_dd} documents.", "fr": "La plus citée : {group_id}, {filtered_dd} documents."},
}


def offline_answer(intent: str, row: dict | None, language: str = "en") -> str:
    """QRY14: a sentence from a template; nothing found is said so."""
    if row is None:
        return "No result." if language == "en" else "Aucun résultat."
    return ANSWERS[intent][language].format(**row)


_QUESTION = (
    ("ranking", re.compile(r"top\s+(?P<top>\d{1,3})\s+most\s+cited(?:\s+cases)?", re.I)),
    ("ranking", re.compile(r"most\s+cited(?:\s+cases)?", re.I)),
    ("court_decade", re.compile(r"(?:citations\s+)?by\s+court\s+and\s+decade", re.I)),
    ("count", re.compile(r"how\s+many\s+citations", re.I)),
    ("case_citations", re.compile(r"(?:who|which\s+documents)\s+cites?", re.I)),
)


def route_question(question: str, courts: list[str]) -> tuple[str, Filters, int]:
    """QRY01: intent, filters and top of a question; words that no rule explains make it unsupported."""
    q = " ".join(question.split())
    if re.search(r"\b(?:select|insert|delete|drop|update|union|pragma|attach)\b", q, re.I):
        raise ValueError("unsupported")
    f = Filters()

    def take(pattern: str):
        nonlocal q
        m = re.search(pattern, q, re.I)
        if m:
            q = q[: m.start()] + " " + q[m.end() :]
        return m

    if m := take(r"\b(?:from|between)\s+(\d{4})\s+(?:to|and)\s+(\d{4})\b"):
        f.year_from, f.year_to = int(m[1]), int(m[2])
    if m := take(r"\bdd\s*(?:>=|≥)\s*(\d+)\b"):
        f.min_dd = int(m[1])
    if m := take(r"\b(?:XC|[A-Z]{2,6})-G\d{6}\b"):
        f.group_id = m[0]
    if m := take(r"\b(foreign|domestic)\b"):
        f.origin = "FOREIGN" if m[1].lower() == "foreign" else "DOMESTIC_CA"
    for c in sorted(courts, key=len, reverse=True):
        if take(rf"\b(?:in|by|of)?\s*\b{re.escape(c)}\b"):
            f.court = c
            break
    for intent, rx in _QUESTION:
        if m := rx.search(q):
            rest = (q[: m.start()] + " " + q[m.end() :]).strip(" ?.!")
            if not rest:
                return intent, f.validate(), int(m.groupdict().get("top") or 10)
    raise ValueError("unsupported")


def answer(question: str, edges: DataFrame, groups: DataFrame, docs: DataFrame, courts: list[str]) -> DataFrame:
    """QRY01, QRY07-QRY10 together."""
    intent, f, top = route_question(question, courts)
    b = base(edges, groups, docs, f)
    return {"count": lambda: metrics(b, []), "ranking": lambda: ranking(b, top), "court_decade": lambda: court_decade(b, docs), "case_citations": lambda: case_citations(b, f.group_id, top)}[intent]()


def group_count(groups: DataFrame, like: str | None = None, min_dd: int | None = None) -> DataFrame:
    """QRY15."""
    g = groups.where(F.col("name").like(like)) if like else groups
    g = g.where(F.col("dd") >= min_dd) if min_dd else g
    return g.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("dd"), F.lit(0)).alias("dd_total"))


def show_case(groups: DataFrame, edges: DataFrame, relations: DataFrame, group_id) -> DataFrame:
    """QRY16: a group with its citing documents by relation."""
    e = edges.where(F.col("group_id") == group_id).join(relations, ["source_id", "group_id"], "left")
    n = e.groupBy("group_id", F.coalesce("relation", F.lit("other_judgment")).alias("relation")).agg(F.count(F.lit(1)).alias("citing"))
    return groups.where(F.col("group_id") == group_id).join(n, "group_id")


def filter_edges(edges: DataFrame, courts: list[str] | None = None, prefix: str | None = None, dated: DataFrame | None = None, related: DataFrame | None = None) -> DataFrame:
    """QRY17: IN list, prefix, and EXISTS on dates and relations as semi joins."""
    e = edges.where(F.col("source_court").isin(courts)) if courts else edges
    e = e.where(F.col("source_id").startswith(prefix)) if prefix else e
    e = e.join(dated.select("source_id").distinct(), "source_id", "left_semi") if dated is not None else e
    return e.join(related.select("source_id", "group_id").distinct(), ["source_id", "group_id"], "left_semi") if related is not None else e


def relation_type(own_hit: Column, source_title: Column, source_year: Column, cited_title: Column, cited_year: Column, history_basis: Column, window: int = 6) -> Column:
    """QRY20."""
    a, b = title_key(source_title), title_key(cited_title)
    near = (a != "") & (a == b) & (source_year - cited_year).between(0, window)
    return F.when(own_hit | blank(history_basis).isin("formal_all", "formal_pair"), "same_case_history").when(blank(history_basis) == "model", "same_case_history_model").when(F.coalesce(near, F.lit(False)), "probable_same_litigation").otherwise("other_judgment")


def beta_score(groups: DataFrame, rates: DataFrame, dd: str = "dd") -> DataFrame:
    """QRY21: the shrunk share of real cases of a group's bucket (rates: dd_bucket, p_real, n_sample), and dd weighted by it."""
    c = rates.select("dd_bucket", ((F.col("p_real") * F.col("n_sample") + 1) / (F.col("n_sample") + 2)).alias("confidence"))
    g = groups.withColumn("dd_bucket", dd_bucket(dd)).join(F.broadcast(c), "dd_bucket")  # four rows
    return g.withColumn("weighted_dd", F.col(dd) * F.col("confidence"))


def best_passages(mentions: DataFrame, per_edge: int, edge: list[str], score: str = "score", order: list[str] | None = None) -> DataFrame:
    """QRY22: the best mentions of each edge, by score, then ledger order."""
    w = Window.partitionBy(*edge).orderBy(F.desc(score), *(order or []))
    return mentions.withColumn("passage_rank", F.row_number().over(w)).where(F.col("passage_rank") <= per_edge)


def case_profiles(edges: DataFrame, group: str = "group_id", source: str = "source_id", dd: str = "dd", candidates: int = 40) -> DataFrame:
    """QRY23: for each group 2, 3 or 4 of its sources (by dd), out of the first 40 in stable random order."""
    w = Window.partitionBy(group).orderBy(spread(source), F.col(source))
    need = F.when(F.col(dd) >= 20, 4).when(F.col(dd) >= 5, 3).otherwise(2)
    return edges.withColumn("context_rank", F.row_number().over(w)).where((F.col("context_rank") <= candidates) & (F.col("context_rank") <= need))


def cached_vectors(texts: DataFrame, cache: DataFrame, text: str = "text") -> DataFrame:
    """QRY24: vectors of texts by content hash (cache: sha, vector); a miss is null, never a call."""
    return texts.withColumn("sha", F.sha2(text, 256)).join(cache, "sha", "left")


#: Queries that travel to all partitions at once.
QUERY_BLOCK = 2048


def _nearest(block, k: int):
    """The best ``k`` rows of a partition for each query of a block, kept batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = block.value
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                own = np.array(part.column("id").to_pylist(), np.int64)
                if not len(own):
                    continue
                v = np.array(part.column("v").to_pylist(), np.float64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = np.round((v / np.linalg.norm(v, axis=1, keepdims=True)) @ q.T, 6)
                top = np.argpartition(-score, min(k, len(own) - 1), axis=0)[: k + 1] if len(own) > k + 1 else np.broadcast_to(np.arange(len(own))[:, None], (len(own), len(ids)))
                least = score[top, np.arange(len(ids))].min(axis=0)
                for i, x in enumerate(ids):
                    # all that are as good as the last of the best, so that ties are cut by id only
                    at_least = np.flatnonzero((score[:, i] >= least[i]) & (own != x))
                    best[i] = sorted([*best[i], *((-score[j, i], int(own[j])) for j in at_least)])[:k]
        rows = [(x, i, -s) for x, found in zip(ids, best, strict=True) for s, i in found]
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_pydict({"q": pa.array(cols[0], pa.int64()), "id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    return run


def knn(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """QRY25: exact nearest neighbours by cosine: the stated queries against all rows, in blocks.

    ``QUERY_BLOCK`` queries at a time travel to every partition, which multiplies them with
    its vectors a batch at a time and keeps the best k of each; only these are
    shuffled. With more than one block each is a staged job of its own, so the driver
    and the executors hold one. Rows without a vector are no neighbours and no queries.
    """
    spark = vectors.sparkSession
    v = vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = queries.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("q"), F.col(vec_col).cast("array<double>").alias("v"))
    parts, best, held = max(1, -(-asked.count() // QUERY_BLOCK)), None, None
    for i in range(parts):
        rows = [(r.q, r.v) for r in asked.where(F.pmod(F.xxhash64("q"), F.lit(parts)) == i).toLocalIterator()]
        q = np.array([r[1] for r in rows], np.float64).reshape(len(rows), -1 if rows else 0)
        sent = spark.sparkContext.broadcast(([r[0] for r in rows], q / np.linalg.norm(q, axis=1, keepdims=True) if len(rows) else q))
        held = v.mapInArrow(_nearest(sent, k), "q long, id long, score double") if rows else v.select(F.col("id").alias("q"), "id", F.lit(0.0).alias("score")).limit(0)
        if parts > 1:
            held = staged(held, "nearest")
            sent.destroy()
        best = held if best is None else best.unionByName(held)
    w = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def trigrams(text: Column) -> Column:
    t = F.lower(blank(text))
    return F.when(F.length(t) >= 3, F.transform(F.sequence(F.lit(1), F.length(t) - 2), lambda i: F.substring(t, i, F.lit(3)))).otherwise(F.array().cast("array<string>"))


#: Grams that one task groups, about.
GRAMS_A_TASK = 1_000_000


def inverted_index(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """QRY26: (gram, id, tf, length) of all texts.

    Texts are dealt by id before they are cut, to as many tasks as their length asks for, so that none groups many more than ``GRAMS_A_TASK`` grams of short texts.
    """
    length = docs.agg(F.sum(F.length(text_col)).alias("n")).first().n or 0
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, length // GRAMS_A_TASK + 1)
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t")).repartition(parts, "id")
    g = d.select("id", trigrams(F.col("_t")).alias("_all")).select("id", F.size("_all").alias("length"), F.explode("_all").alias("gram"))
    return g.groupBy("gram", "id").agg(F.count(F.lit(1)).alias("tf"), F.max("length").alias("length"))


def bm25(docs: DataFrame, query: str, k: int, id_col: str, text_col: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """QRY26, FN33: texts by BM25 over the words of a question; only texts that hold one of them are counted."""
    spark: SparkSession = docs.sparkSession
    terms = [r for r in spark.range(1).select(F.explode(query_terms(F.lit(query))).alias("t")).toPandas()["t"]]
    words = F.split(F.lower(blank(text_col)), r"(?U)[^\p{L}\p{N}]+")
    d = docs.select(F.col(id_col).alias("id"), F.filter(words, lambda w: w != "").alias("_w")).withColumn("n", F.size("_w"))
    stats = d.agg(F.count(F.lit(1)).alias("total"), F.avg("n").alias("avg"))
    hits = d.select("id", "n", F.explode(F.filter("_w", lambda w: w.isin(*terms or [""]))).alias("term")).groupBy("id", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    s = hits.join(F.broadcast(df), "term").crossJoin(F.broadcast(stats))  # a row per term, and one row
    idf = F.log(1 + (F.col("total") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    s = s.withColumn("_s", idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.col("avg"))))
    return ranked(s.groupBy("id").agg(F.round(F.sum("_s"), 6).alias("score")), [F.desc("score"), F.asc("id")], k)


def rrf(channels: list[DataFrame], k: int, prior: DataFrame | None = None, weight: float = 0.5) -> DataFrame:
    """QRY18, QRY19: reciprocal-rank fusion of (id, rank from 1), plus weight * ln(1 + prior) / 60; filters go below the channels."""
    r = channels[0].select("id", "rank")
    for c in channels[1:]:
        r = r.unionByName(c.select("id", "rank"))
    s = r.groupBy("id").agg(F.sum(1.0 / (RRF + F.col("rank") - 1)).alias("_s"))
    if prior is not None:
        s = s.join(prior, "id", "left").withColumn("_s", F.col("_s") + F.coalesce(weight * F.log1p("prior") / RRF, F.lit(0.0)))
    return ranked(s.select("id", F.round("_s", 9).alias("score")), [F.desc("score"), F.asc("id")], k)


def import_checks(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """QRY27: duplicate edges, edges without a group, groups whose dd is not their number of sources."""
    pairs = edges.groupBy("source_id", "group_id").agg(F.count(F.lit(1)).alias("n"))
    seen = pairs.groupBy("group_id").agg(F.count("source_id").alias("_d"), F.sum("n").alias("_n"), F.count_if(F.col("n") > 1).alias("_dup"))
    seen = staged(seen, "import-groups")  # the edges are read once
    dup = seen.agg(F.coalesce(F.sum("_dup"), F.lit(0)).alias("duplicate_edges"))
    orphan = seen.join(groups.select("group_id"), "group_id", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_edges"))
    dd = groups.join(seen, "group_id", "left").where(F.col("dd") != F.coalesce("_d", F.lit(0))).agg(F.count(F.lit(1)).alias("wrong_dd"))
    return dup.crossJoin(orphan).crossJoin(dd)

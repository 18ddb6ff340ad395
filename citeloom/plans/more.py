"""More registered queries over the star-schema views, with their SQL: classification rules, registry, identity, origin, stored judgments, sources."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from citeloom.functions import scalar as fn
from citeloom.operators import analytics as an
from citeloom.operators import classify, decide, identity, integrity, merge, quality, scorer, search_index
from citeloom.plans.catalog import NK, ORACLES, OWN, RUN_ORDER, RUNS, _bridge, _ordered, _own, _solved, _solver_rows, query
from citeloom.plans.views import D, E, G, I, M
from citeloom.sources import corpus
from citeloom.sources.store import Stage, Store, same_keys, unique
from citeloom.staging import shared_dir

# --- sources


def _written(v, df, name: str, **options) -> str:
    """A CSV folder of a table in the shared folder."""
    import uuid

    path = f"{shared_dir(v.spark)}/citeloom-{name}-{uuid.uuid4().hex}.csv"
    df.write.csv(path, header=True, **options)
    return path


@query("dimension_rows", "SELECT n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def _(v):
    path = _written(v, v.t("nation").select("n_name", "n_regionkey"), "dimensions/nation")
    folder, _, name = path.rpartition("/")
    return corpus.Dimensions(v.spark, folder, {name.removesuffix(".csv"): ["n_name", "n_regionkey"]})[name.removesuffix(".csv")]


@query("imported_rows", "SELECT CAST(r_regionkey AS VARCHAR) AS r_regionkey, r_name, 'r1' AS run_id FROM region")
def _(v):
    rows = corpus.read_rows(v.spark, _written(v, v.t("region").select("r_regionkey", "r_name"), "rows", compression="gzip"), ["r_name"])
    corpus.import_run({"regions": rows}, "r1", "imported")
    return v.spark.table("imported_regions")


@query("corpus_rows", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS first_row, count(*) - 1 AS last_row, count(*) AS different, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS characters FROM documents")
def _(v):
    import uuid

    path = f"{shared_dir(v.spark)}/citeloom-corpus-{uuid.uuid4().hex}"
    d = v.t("documents")
    corpus.write_table(d.select(F.col("doc_id").cast("string").alias("citation_en"), F.col("source").alias("name_en"), F.col("text").alias("unofficial_text_en"), "lang"), path)
    r = corpus.read_corpus(v.spark, path, "X")
    i = F.col("corpus_row_index")
    return r.agg(F.count(F.lit(1)).alias("n"), F.min(i).alias("first_row"), F.max(i).alias("last_row"), F.count_distinct(i).alias("different"), F.sum(F.length(fn.blank("unofficial_text_en"))).alias("characters"))


@query("interval_winners", f"""WITH {I}, l AS (SELECT DISTINCT doc, "start", "end" FROM i WHERE event_type = 'view'), j AS (SELECT l.*, k."start" AS ws, k."end" AS we, row_number() OVER (PARTITION BY l.doc, l."start", l."end" ORDER BY k."end" - k."start" DESC, k."start") AS r FROM l JOIN i k ON k.doc = l.doc AND k.event_type = 'click' AND l."start" < k."end" AND k."start" < l."end")
  SELECT doc, "start", "end", ws AS winner_start, we AS winner_end FROM j WHERE r = 1""")
def _(v):
    i = v.intervals().withColumn("superseded_by", F.when(F.col("event_type") == "view", "x"))
    kept, gone = corpus.split_superseded(i)
    return quality.losers_winner(gone, kept.where("event_type = 'click'"))


# --- classification rules

CLS_CASES = """c AS (SELECT p_partkey, p_partkey % 8 AS k, CASE p_partkey % 8 WHEN 0 THEN 'March' WHEN 1 THEN 'Sept' WHEN 2 THEN 'Section' WHEN 3 THEN 'Reg. Gaz.' WHEN 4 THEN 'Brand' ELSE 'Q.X.' END AS abbr FROM part)"""


def _rejected(v):
    k = F.col("p_partkey") % 8
    p = v.t("part").select(
        "p_partkey", F.when(k == 0, "March").when(k == 1, "Sept").when(k == 2, "Section").when(k == 3, "Reg. Gaz.").when(k == 4, "Brand").otherwise("Q.X.").alias("abbreviation"),
        F.when(k == 5, "S.C. 1985 Q.X. 3").otherwise("12 Q.X. 1990").alias("raw_string"), F.when(k == 5, "the Act, c. 12, ").otherwise("see ").alias("preceding_text"), F.lit("12").alias("vol"), F.lit("1990").alias("page"),
        F.when(k == 6, "v").otherwise("").alias("page_roman"), F.lit("reporter").alias("citation_kind"), (k == 7).alias("table_conflict"), F.when(k == 4, F.lit(1)).alias("reporter_exact"), F.lit(None).cast("int").alias("reporter_norm"),
    )
    return classify.rejections(p, {"whole": ["section", "brand"]}, ({}, [(r"Gaz\.$", "gazette")]))


@query("rejections", f"WITH {CLS_CASES} SELECT p_partkey, CASE k WHEN 0 THEN 'date_form' WHEN 1 THEN 'abbreviated_date_form' WHEN 2 THEN 'non_citation_word' WHEN 3 THEN 'non_case_gazette' WHEN 5 THEN 'federal_statute' WHEN 6 THEN 'versus_as_page' WHEN 7 THEN 'table_conflict' ELSE '' END AS rejected_reason FROM c")
def _(v):
    return _rejected(v).select("p_partkey", "rejected_reason")


@query("registered_ids", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 'UNSUPPORTED' WHEN p_size > 25 THEN 'CA' ELSE 'UNSUPPORTED' END AS jurisdiction, CASE WHEN p_partkey % 5 = 0 THEN 'docket_not_decision' WHEN p_partkey % 3 = 1 THEN 'unverified_id_prefix' ELSE '' END AS reason FROM part")
def _(v):
    k = F.col("p_partkey")
    r = classify.registered_id(F.when(k % 5 == 0, "docket").otherwise("decision"), F.when(k % 3 == 1, "open").otherwise("verified_x"), F.when(F.col("p_size") > 25, "CA"))
    return v.t("part").select("p_partkey", r.alias("r")).select("p_partkey", "r.jurisdiction", "r.reason")


@query("materials", "SELECT p_partkey, CASE WHEN p_size > 40 THEN '' WHEN p_name LIKE '%ring' THEN 'ring' WHEN lower(replace(p_name, ' ', '')) = 'redwidget' THEN 'red' ELSE '' END AS material FROM part")
def _(v):
    return v.t("part").select("p_partkey", classify.non_case_material(F.col("p_name"), F.col("p_size") > 40, {"redwidget": "red"}, [("ring$", "ring")]).alias("material"))


@query("weakest_confidence", "SELECT p_brand, CASE WHEN min(p_size) < 5 THEN 'inferred' ELSE 'confirmed' END AS weakest, 'inferred' AS capped FROM part GROUP BY p_brand")
def _(v):
    a = v.t("part").groupBy("p_brand").agg(F.collect_set(F.struct(F.when(F.col("p_size") < 5, "inferred").otherwise("confirmed").alias("confidence"))).alias("rows"))
    return a.select("p_brand", classify.weakest(F.col("rows")).alias("weakest"), classify.weakest(F.col("rows"), "inferred").alias("capped"))


@query("volume_systems", "SELECT p_partkey, CASE WHEN p_brand >= 'Brand#3' THEN '' WHEN p_size < 20 THEN 'continuous' WHEN p_size > 30 THEN 'year_volume' ELSE '' END AS volume_system FROM part")
def _(v):
    brands = v.t("part").where("p_brand < 'Brand#3'").select(fn.nk("p_brand").alias("key")).distinct()
    one = lambda s, a, b: brands.select("key", F.lit(s).alias("system"), F.lit(a).alias("vol_from"), F.lit(b).alias("vol_to"), F.lit(None).cast("int").alias("year_from"), F.lit(None).cast("int").alias("year_to"))
    p = v.t("part").select("p_partkey", F.col("p_brand").alias("abbreviation"), F.col("p_size").cast("string").alias("vol"), F.lit("").alias("year_start"))
    return classify.volume_system(p, one("continuous", 1, 30).unionByName(one("year_volume", 20, 99))).select("p_partkey", "volume_system")


LABELS = "CASE p_partkey % 6 WHEN 0 THEN 'H.L.' WHEN 1 THEN 'C.A.' WHEN 2 THEN 'P C' WHEN 3 THEN 'at p. 5' WHEN 4 THEN '' ELSE 'Zzz' END"


@query("court_designations", """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'recognized' WHEN 1 THEN CASE WHEN p_brand < 'Brand#3' THEN 'recognized' ELSE 'ambiguous_designation' END WHEN 2 THEN 'ambiguous_designation' WHEN 3 THEN 'not_a_court' WHEN 4 THEN '' ELSE 'unrecognized' END AS status,
  CASE p_partkey % 6 WHEN 0 THEN 'UKHL' WHEN 1 THEN CASE WHEN p_brand < 'Brand#3' THEN 'ONCA' ELSE '' END ELSE '' END AS court FROM part""")
def _(v):
    k = F.col("p_partkey") % 6
    label = F.when(k == 0, "H.L.").when(k == 1, "C.A.").when(k == 2, "P C").when(k == 3, "at p. 5").when(k == 4, "").otherwise("Zzz")
    table = v.spark.createDataFrame([("hl", "recognized", "UKHL"), ("ca", "ambiguous_designation", ""), ("pc", "recognized", "UKPC")], "key string, status string, canonical_court string")
    scope = v.t("part").where("p_brand < 'Brand#3'").select(F.lit("ca").alias("key"), fn.nk("p_brand").alias("reporter"), F.lit("ONCA").alias("canonical_court")).distinct()
    r = classify.court_designation(v.t("part").select("p_partkey", label.alias("court_designation_raw"), F.col("p_brand").alias("abbreviation")), table, scope)
    return r.select("p_partkey", F.col("court_designation_status").alias("status"), F.col("observed_deciding_court").alias("court"))


@query("suffix_labels", "SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'H.L.' WHEN 1 THEN 'CanLII' WHEN 2 THEN 'H.L.,CanLII' WHEN 3 THEN 'H.L.,S.C.C.' ELSE '' END AS allowed, CASE p_partkey % 5 WHEN 0 THEN 'recognized' WHEN 1 THEN 'not_a_court' WHEN 2 THEN 'recognized' WHEN 3 THEN 'conflict' ELSE 'unrecognized' END AS status, CASE p_partkey % 5 WHEN 0 THEN 'UKHL' WHEN 2 THEN 'UKHL' ELSE '' END AS court, CASE p_partkey % 5 WHEN 0 THEN 'H.L.' WHEN 1 THEN 'CanLII' WHEN 2 THEN 'CanLII,H.L.' WHEN 3 THEN 'H.L.,S.C.C.' ELSE 'zzz' END AS asked FROM part")
def _(v):
    k = F.col("p_partkey") % 5
    lists = [["H.L."], ["CanLII"], ["H.L.", "CanLII"], ["H.L.", "S.C.C."], ["zzz"]]
    each = F.array(*[F.array(*[F.struct(F.lit(x).alias("raw")) for x in xs]) for xs in lists])
    notes = F.get(each, k.cast("int"))
    courts = F.create_map(F.lit("hl"), F.lit("UKHL"), F.lit("scc"), F.lit("SCC"))
    r = v.t("part").select("p_partkey", classify.classify_suffixes(notes, courts, ["canlii"]).alias("r"), F.array_join(scorer.suffix_questions(notes), ",").alias("asked"))
    return r.select("p_partkey", F.array_join("r.allowed", ",").alias("allowed"), "r.status", "r.court", "asked")


@query("self_citations", "SELECT o_orderkey, o_orderkey % 3 = 0 AS self FROM orders")
def _(v):
    n = F.col("o_orderkey").cast("string")
    raw = F.concat(F.lit("2020 SCC 0"), F.when(F.col("o_orderkey") % 3 == 0, n).otherwise(F.concat(n, F.lit("7"))))
    return v.t("orders").select("o_orderkey", classify.self_citation(raw, F.concat(F.lit("SCC_2020scc"), n)).alias("self"))


# --- runs printed side by side

RUN_ROWS = RUNS + """, k AS (SELECT source_id, run FROM r GROUP BY 1, 2 HAVING count(DISTINCT merge_key) >= 2), g AS (SELECT r.*, row_number() OVER (PARTITION BY r.source_id, run ORDER BY position, group_id, supp, merge_key) - 1 AS i FROM r JOIN k USING (source_id, run))"""


@query("run_evidence", RUN_ROWS + """, f AS (SELECT source_id || ':' || run AS instance, i, group_id % 11 = 0 AS d FROM g) SELECT instance, fault FROM (
    SELECT instance, CASE WHEN d THEN 'differs_from_ledger' END AS fault FROM f UNION ALL SELECT instance, CASE WHEN i > 0 AND hash_gap THEN 'gap_not_parallel' END FROM (SELECT *, false AS hash_gap FROM f)) WHERE fault IS NOT NULL GROUP BY 1, 2""")
def _(v):
    w = Window.partitionBy("source_id").orderBy(*RUN_ORDER)
    r = _ordered(v).withColumn("_at", F.row_number().over(w))
    same = F.coalesce(F.col("year") == F.col("py"), F.lit(False))
    row = r.withColumns({"candidate_id": F.concat_ws(":", "source_id", "_at"), "start": 10 * F.col("_at"), "end": 10 * F.col("_at") + 5, "gap": F.when(same, ", ").otherwise("; "), "joins": same})
    counted = row.select(F.col("source_id").alias("doc"), "candidate_id", "merge_key", "start", "end", "gap", "joins")
    runs = merge.islands(row, "source_id", RUN_ORDER, same)
    stored = runs.select(
        F.concat_ws(":", "source_id", "run").alias("instance"), "member_index", "candidate_id", "merge_key", F.when(F.col("group_id") % 11 == 0, F.col("start") + 1).otherwise(F.col("start")).alias("start"), "end",
        F.when(F.col("member_index") > 0, F.col("gap")).otherwise("").alias("gap_before"),
    )
    return merge.run_evidence(stored, counted)


@query("checked_runs", RUN_ROWS + " SELECT source_id || ':' || run AS instance, count(*) AS members FROM g GROUP BY 1")
def _(v):
    w = Window.partitionBy("source_id").orderBy(*RUN_ORDER)
    same = F.coalesce(F.col("year") == F.col("py"), F.lit(False))
    row = _ordered(v).withColumn("_at", F.row_number().over(w)).withColumns({"candidate_id": F.concat_ws(":", "source_id", "_at"), "start": 10 * F.col("_at"), "end": 10 * F.col("_at") + 5, "gap": F.when(same, ", ").otherwise("; "), "joins": same})
    stored = merge.islands(row, "source_id", RUN_ORDER, same).select(F.concat_ws(":", "source_id", "run").alias("instance"), "member_index", "candidate_id", "merge_key", "start", "end", F.when(F.col("member_index") > 0, F.col("gap")).otherwise("").alias("gap_before"))
    counted = row.select(F.col("source_id").alias("doc"), "candidate_id", "merge_key", "start", "end", "gap", "joins")
    return merge.checked_runs(stored, counted).groupBy("instance").agg(F.count(F.lit(1)).alias("members"))


# --- registry and evidence


@query("registry_rows", f"WITH {M} SELECT DISTINCT merge_key, source_id AS decision_id, 'X' AS source_court, 'self_citation' AS source FROM m WHERE flag = 'A' UNION ALL SELECT DISTINCT merge_key, source_id, 'X', 'corpus' FROM m WHERE flag = 'R'")
def _(v):
    m = v.mentions().select("merge_key", F.col("source_id").alias("decision_id"), F.lit("X").alias("source_court"), "flag")
    return identity.registry(m.where("flag = 'A'").drop("flag"), m.where("flag = 'R'").drop("flag"))


@query("self_entries", f"WITH {M}, a AS (SELECT merge_key, string_agg(DISTINCT source_id, '|' ORDER BY source_id) AS s FROM m WHERE flag = 'A' GROUP BY merge_key) SELECT merge_key, unnest(string_split(s, '|')) AS decision_id, 'X' AS source_court FROM a")
def _(v):
    a = v.mentions().where("flag = 'A'").groupBy("merge_key").agg(F.array_join(F.array_sort(F.collect_set("source_id")), "|").alias("self_citation_of"))
    return identity.self_entries(a.withColumns({"citation_kind": F.lit("neutral"), "source_court": F.lit("X")}))


@query("one_key_per_citation", f"""WITH {M}, a AS (SELECT source_id AS citation_id, count(*) AS n, min(merge_key) AS k, bool_or(flag = 'R') AS r, max(qty) AS s FROM m GROUP BY 1)
  SELECT citation_id, CASE WHEN n = 1 AND NOT r AND s <> 7 THEN k END AS merge_key, CASE WHEN n > 1 THEN 'several_keys' WHEN r THEN 'rejected' WHEN s = 7 THEN 'text_outside' ELSE '' END AS reason FROM a""")
def _(v):
    m = v.mentions().select(F.col("source_id").alias("citation_id"), "merge_key", F.col("qty").alias("match_span"), F.when(F.col("qty") == 7, 8).otherwise(F.col("qty")).alias("text_length"), F.when(F.col("flag") == "R", "x").otherwise("").alias("rejected_reason"))
    return identity.one_key(m)


@query("own_claims", """WITH c AS (SELECT DISTINCT p_brand || p_size AS merge_key, p_name AS decision_id, p_size % 2 AS corpus_row, p_partkey % 3 <> 0 AS proven FROM part), k AS (SELECT merge_key, count(DISTINCT decision_id) AS d FROM c WHERE proven GROUP BY 1), e AS (SELECT decision_id, count(DISTINCT corpus_row) AS r, count(DISTINCT CASE WHEN proven THEN merge_key END) AS n FROM c GROUP BY 1)
  SELECT c.merge_key, c.decision_id, c.corpus_row, c.proven, CASE WHEN NOT proven THEN 'unproven' WHEN r > 1 THEN 'ambiguous_source_row' WHEN d > 1 THEN 'key_of_several_documents' WHEN n < 2 THEN 'single_claim' ELSE 'qualified' END AS claim_status FROM c LEFT JOIN k USING (merge_key) JOIN e USING (decision_id)""")
def _(v):
    c = v.t("part").select(F.concat("p_brand", F.col("p_size").cast("string")).alias("merge_key"), F.col("p_name").alias("decision_id"), (F.col("p_size") % 2).alias("corpus_row"), (F.col("p_partkey") % 3 != 0).alias("proven")).distinct()
    # one claim a row, so that the statuses can be told apart
    named = c.withColumn("merge_key", F.concat_ws("@", "merge_key"))
    s = identity.own_citations(named).distinct()
    return c.join(s.select("merge_key", "decision_id", (F.col("claim_status") != "unproven").alias("proven"), "claim_status").distinct(), ["merge_key", "decision_id", "proven"]).select("merge_key", "decision_id", "corpus_row", "proven", "claim_status")


@query("pair_separations", "SELECT DISTINCT least(p_brand, p_type) AS a, greatest(p_brand, p_type) AS b, true AS known FROM part")
def _(v):
    p = v.t("part")
    keys = p.select(F.col("p_brand").alias("merge_key")).union(p.select("p_type"))
    return identity.pair_separations(p.select(F.col("p_brand").alias("left_merge_key"), F.col("p_type").alias("right_merge_key")), keys)


@query("court_tokens", "SELECT 'l' || n_nationkey AS label, 'c' || n_regionkey AS court_token FROM nation UNION SELECT 'c' || n_regionkey, 'c' || n_regionkey FROM nation")
def _(v):
    return identity.court_tokens(v.t("nation").select(F.concat(F.lit("l"), F.col("n_nationkey").cast("string")).alias("a"), F.concat(F.lit("c"), F.col("n_regionkey").cast("string")).alias("b")))


@query("scope_conflicts", "SELECT p_partkey, p_size % 3 > 0 AND p_partkey % 3 > 0 AND p_size % 3 <> p_partkey % 3 AS conflict FROM part")
def _(v):
    one = lambda c: F.when(c % 3 == 0, F.array().cast("array<string>")).otherwise(F.array((c % 3).cast("string")))
    return v.t("part").select("p_partkey", identity.scope_conflict(one(F.col("p_size")), one(F.col("p_partkey"))).alias("conflict"))


@query("evidence_snapshot", f"""WITH {M}, d AS (SELECT DISTINCT merge_key, kind FROM m) SELECT 'court' AS fact_kind, merge_key, kind AS value, 'key' AS scope, sha256('{{"fact_kind":"court","merge_key":"' || merge_key || '","scope":"key","value":"' || kind || '"}}') AS evidence_id FROM d""")
def _(v):
    return identity.evidence_snapshot(v.mentions(), "court", "kind", "key")


# --- stored indexes and published runs


def _folder(v, name: str) -> str:
    """A new folder in the one that the cluster shares."""
    import uuid

    return f"{shared_dir(v.spark)}/citeloom-{name}-{uuid.uuid4().hex}"


@query("stored_bm25", ORACLES["keyword_bm25"])
def _(v):
    index = search_index.WordIndex(v.spark, _folder(v, "words"))
    d = v.t("documents")
    index.add(d.where("doc_id % 3 = 0"), "doc_id", "text")  # two segments, all documents
    index.add(d.where("doc_id % 3 <> 0"), "doc_id", "text")
    return index.search("Stupid license, under a password?", 20)


@query("vector_index_recall", "SELECT true AS enough, count(*) AS queries FROM embeddings WHERE vec_id % 50 = 0")
def _(v):
    e = v.t("embeddings")
    asked = e.where("vec_id % 50 = 0")
    found = search_index.VectorIndex(e).search(asked, 10)
    return search_index.recall(found, an.knn(e, asked, 10)).select((F.col("recall") >= 0.9).alias("enough"), "queries")


@query("published_tables", "SELECT s_suppkey, s_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(v):
    store = Store(v.spark, _folder(v, "store"))
    checks = {"suppliers of known nations": same_keys("supplier", "nation", ["n_nationkey"]), "one row for each supplier": unique("supplier", ["s_suppkey"])}
    store.publish({"supplier": v.t("supplier").withColumn("n_nationkey", F.col("s_nationkey")), "nation": v.t("nation").select("n_nationkey", "n_name")}, checks)
    run = store.open()
    return run["supplier"].join(run["nation"], "n_nationkey").select("s_suppkey", "s_nationkey", "n_name")


# the second run finds other countries: only what reads them is made anew
@query("replayed_stages", "SELECT unnest(['orders', 'by_nation', 'regions']) AS stage, unnest([false, true, true]) AS made, (SELECT count(DISTINCT n_nationkey % 2) FROM nation) AS regions")
def _(v):
    store = Store(v.spark, _folder(v, "store"))
    stages = [
        Stage("orders", ("orders",), lambda o: o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))),
        Stage("by_nation", ("orders", "customer", "nation"), lambda o, c, n: o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"]).groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))),
        Stage("regions", ("by_nation",), lambda b: b.agg(F.count(F.lit(1)).alias("regions"))),
    ]
    tables = {t: v.t(t) for t in ("orders", "customer", "nation")}
    store.replay(tables, stages)
    run, made = store.replay(tables | {"nation": v.t("nation").withColumn("n_regionkey", F.col("n_nationkey") % 2)}, stages)
    told = v.spark.createDataFrame([(s.name, s.name in made) for s in stages], "stage string, made boolean")
    return told.crossJoin(F.broadcast(run["regions"]))


@query("offline_answer", f"WITH {G} SELECT 'en' AS language, 'Most cited: ' || group_id || ' with ' || dd || ' documents.' AS answer FROM (SELECT * FROM g ORDER BY dd DESC, group_id LIMIT 1) UNION ALL SELECT 'fr', 'La plus citée : ' || group_id || ', ' || dd || ' documents.' FROM (SELECT * FROM g ORDER BY dd DESC, group_id LIMIT 1)")
def _(v):
    best = v.groups().select("group_id", F.col("dd").alias("filtered_dd")).orderBy(F.desc("filtered_dd"), "group_id").first().asDict()
    return v.spark.createDataFrame([(lang, an.offline_answer("ranking", best, lang)) for lang in ("en", "fr")], "language string, answer string")


# nations in the order of two lists that agree: by key, and every other one by key
@query("court_order", "SELECT row_number() OVER (ORDER BY n_nationkey) AS place, n_name FROM nation")
def _(v):
    names = [r.n_name for r in v.t("nation").orderBy("n_nationkey").collect()]  # a dimension: one row for each court
    order = quality.court_order(names, names[::2])
    return v.spark.createDataFrame([(i, n) for i, n in enumerate(order, 1)], "place long, n_name string")


# a CSV and its packed form have one content, and a manifest names the language policy
@query("logical_content", "SELECT count(*) AS rows, true AS same, 'english_only' AS old_policy, 'en_then_fr' AS policy FROM nation")
def _(v):
    rows = v.t("nation").select("n_nationkey", "n_name")
    plain, packed = (v.spark.read.csv(_written(v, rows, name, **options), header=True) for name, options in (("plain", {}), ("packed", {"compression": "gzip"})))
    a, b = corpus.table_signature(plain), corpus.table_signature(packed).select(F.col("n_rows").alias("m"), F.col("row_hash").alias("h"))
    told = [F.lit(corpus.policy_from_manifest(m)) for m in ({}, {"text_policy": "en_then_fr"})]
    return a.crossJoin(F.broadcast(b)).select(F.col("n_rows").alias("rows"), ((F.col("n_rows") == F.col("m")) & (F.col("row_hash") == F.col("h"))).alias("same"), told[0].alias("old_policy"), told[1].alias("policy"))


# --- identity

SOLVED = """RECURSIVE k AS (SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_name AS name, CAST(p_partkey % 9 + 1990 AS INTEGER) AS year, CASE WHEN p_size > 45 THEN p_type END AS court FROM part), y AS (SELECT DISTINCT name, year FROM k),
  w AS (SELECT name, min(year) AS ws FROM y GROUP BY name UNION ALL SELECT w.name, (SELECT min(year) FROM y WHERE y.name = w.name AND y.year > w.ws + 1) FROM w WHERE EXISTS (SELECT 1 FROM y WHERE y.name = w.name AND y.year > w.ws + 1)),
  s AS (SELECT k.*, w.ws, min(row_key) OVER (PARTITION BY k.name, w.ws) AS lead FROM k JOIN w ON k.name = w.name AND k.year BETWEEN w.ws AND w.ws + 1), c AS (SELECT name, ws, arg_min(court, CASE WHEN row_key = lead THEN '' ELSE row_key END) AS first_court FROM s WHERE court IS NOT NULL GROUP BY 1, 2),
  t AS (SELECT s.*, row_key = lead OR court IS NULL OR court = first_court AS joined FROM s LEFT JOIN c USING (name, ws)), g AS (SELECT row_key, CASE WHEN joined THEN lead ELSE row_key END AS group_id FROM t)"""


@query("identity_solution", f"WITH {SOLVED} SELECT * FROM g")
def _(v):
    return _solved(v)[1][0]


@query("identity_rounds", f"WITH {SOLVED} SELECT * FROM g")
def _(v):
    k, links = _solver_rows(v)
    return identity.solve(k, links, group_rows=0)[0]


@query("identity_basis", f"WITH {SOLVED} SELECT row_key, group_id, CASE WHEN count(*) OVER (PARTITION BY group_id) = 1 THEN 'singleton' WHEN row_key = group_id THEN 'anchor' ELSE 'name_year' END AS identity_basis FROM g")
def _(v):
    return identity.identity_basis(*_solved(v)[1])


@query("identity_trace", f"""WITH {SOLVED} SELECT row_key AS a, lead AS b, 'name_year' AS rule, CASE WHEN joined THEN 'accepted' ELSE 'positive_court_conflict' END AS outcome, CASE WHEN joined THEN 'must_link' ELSE 'cannot_link' END AS relation, sha256('{{"a":"' || row_key || '","b":"' || lead || '","rule":"name_year"}}') AS constraint_id FROM t WHERE row_key <> lead""")
def _(v):
    return _solved(v)[1][1]


@query("alias_links", "WITH o AS (SELECT p_brand || '|' || p_partkey AS merge_key, p_name AS decision_id FROM part WHERE p_size > 10), l AS (SELECT decision_id, min(merge_key) AS b FROM o GROUP BY 1) SELECT merge_key AS a, b, 'document_alias' AS rule FROM o JOIN l USING (decision_id) WHERE merge_key <> b")
def _(v):
    k = F.concat_ws("|", "p_brand", F.col("p_partkey").cast("string"))
    p = v.t("part")
    return identity.alias_links(p.where("p_size > 10").select(k.alias("merge_key")), p.select(k.alias("merge_key"), F.col("p_name").alias("decision_id")))


@query("same_key_links", f"WITH {M}, k AS (SELECT DISTINCT merge_key, merge_key || '@' || supp AS row_key FROM m), l AS (SELECT merge_key, min(row_key) AS b FROM k GROUP BY 1) SELECT row_key AS a, b, 'same_citation' AS rule FROM k JOIN l USING (merge_key) WHERE row_key <> b")
def _(v):
    return identity.same_key_links(v.mentions().select("merge_key", F.concat_ws("@", "merge_key", F.col("supp").cast("string")).alias("row_key")).distinct())


@query("run_links", RUN_ROWS + ", f AS (SELECT source_id, run, min(merge_key) AS b FROM g GROUP BY 1, 2) SELECT merge_key AS a, b, 'co_printed_run' AS rule FROM g JOIN f USING (source_id, run) WHERE merge_key <> b GROUP BY 1, 2")
def _(v):
    runs = merge.islands(_ordered(v), "source_id", RUN_ORDER, F.coalesce(F.col("year") == F.col("py"), F.lit(False)))
    return identity.run_links(runs.select(F.col("source_id").alias("doc"), "run", "merge_key"))


@query("mixed_names", f"WITH {M}, n AS (SELECT supp, count(DISTINCT {NK.format('name')}) AS k, bool_or({NK.format('name')} = 'redwidget') AS r FROM m GROUP BY supp) SELECT supp, r AND k > 1 AS mixed FROM n")
def _(v):
    return merge.name_classes(v.mentions(), "supp", "name").select("supp", identity.mixed_name(fn.parse_name_classes("name_classes"), F.lit("redwidget")).alias("mixed"))


@query("registry_gates", "SELECT p_partkey, p_size % 2 = 0 OR NOT (p_partkey % 3 = 0) AS literal, p_size % 2 = 0 OR NOT (p_partkey % 3 = 0 OR p_partkey % 5 = 0) AS either, CASE WHEN p_partkey % 5 = 0 THEN false ELSE p_size % 2 = 0 OR NOT (p_partkey % 5 = 0) END AS registered FROM part")
def _(v):
    k = F.col("p_partkey")
    gate = lambda mode: identity.gate_allows(mode, F.lit("typo_number"), k % 5 == 0, k % 3 == 0, F.col("p_size") % 2 == 0)
    return v.t("part").select("p_partkey", gate("literal").alias("literal"), gate("own_or_registry").alias("either"), gate("registered").alias("registered"))


# part k may vary the parts up to three before it, which have more sources; going through them in order is one step of the recursion each
@query("decision_roots", """WITH RECURSIVE p AS (SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS s FROM part), r AS (
  SELECT CAST(-1 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS big, false AS held, true AS f1, true AS f2, true AS f3 UNION ALL
  SELECT k, big, held, big IS NOT NULL AND NOT held, f1, f2 FROM (SELECT k, f1, f2, big, coalesce((s + big) % 7 = 0, false) AS held FROM (
    SELECT p.k, p.s, r.f1, r.f2, CASE WHEN s % 5 = 0 AND NOT f3 THEN p.k - 3 WHEN s % 3 = 0 AND NOT f2 THEN p.k - 2 WHEN s % 2 = 0 AND NOT f1 THEN p.k - 1 END AS big FROM r JOIN p ON p.k = r.k + 1)))
  SELECT 'k' || k AS merge_key, 'k' || CASE WHEN big IS NULL OR held THEN k ELSE big END AS root, CASE WHEN big IS NULL OR held THEN 'anchor' ELSE 'typo_year' END AS root_kind FROM r WHERE k >= 0""")
def _(v):
    name = lambda c: F.concat(F.lit("k"), c.cast("string"))
    p, k, s = v.t("part"), F.col("p_partkey"), F.col("p_size")
    near = F.filter(F.array(F.when(s % 5 == 0, k - 3), F.when(s % 3 == 0, k - 2), F.when(s % 2 == 0, k - 1)), lambda b: b >= 0)
    var = p.select(k, s, F.explode(near).alias("b")).select(name(k).alias("small"), name(F.col("b")).alias("big"), F.lit("typo_year").alias("kind"), (-F.col("b")).alias("big_sources"), ((s + F.col("b")) % 7 == 0).alias("held"))
    return identity.decision_roots(p.select(name(k).alias("merge_key")), var)


# groups of suppliers; in each, the two first ones are the sides of a printed history, the others follow the one that they share enough orders with
@query("history_parts", """WITH k AS (SELECT s_suppkey % 9 AS group_id, 'S' || s_suppkey AS key, s_suppkey AS n FROM supplier), b AS (SELECT DISTINCT 'S' || l_suppkey AS key, l_orderkey % 997 AS source_id FROM lineitem),
  o AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY n) AS r FROM k), u AS (SELECT group_id, key AS part FROM o WHERE r <= 2), c AS (SELECT key, count(*) AS n FROM b GROUP BY key),
  hit AS (SELECT o.key, u.part, count(*) AS x FROM o JOIN u USING (group_id) JOIN b ON b.key = o.key JOIN b d ON d.key = u.part AND d.source_id = b.source_id WHERE o.r > 2 GROUP BY ALL),
  f AS (SELECT hit.key, min(part) AS part FROM hit JOIN c p ON p.key = hit.key JOIN c q ON q.key = hit.part WHERE x >= 0.46 * least(p.n, q.n) GROUP BY hit.key HAVING count(*) = 1),
  t AS (SELECT o.group_id, o.key, CASE WHEN r <= 2 THEN o.key ELSE coalesce(f.part, '') END AS p, CASE WHEN r <= 2 THEN 'history_separation' WHEN f.part IS NOT NULL THEN 'history_follows' ELSE 'history_unassigned' END AS reason FROM o LEFT JOIN f USING (key))
  SELECT key AS row_key, group_id, CASE WHEN count(*) OVER (PARTITION BY group_id) < 2 THEN CAST(group_id AS VARCHAR) ELSE min(key) OVER (PARTITION BY group_id, p) END AS part, CASE WHEN count(*) OVER (PARTITION BY group_id) < 2 THEN '' ELSE reason END AS reason FROM t""")
def _(v):
    key = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    m = v.t("supplier").select((F.col("s_suppkey") % 9).alias("group_id"), key.alias("row_key"), key.alias("merge_key"), F.lit("").alias("court"), "s_suppkey")
    nth = F.row_number().over(Window.partitionBy("group_id").orderBy("s_suppkey"))
    sides = m.withColumn("r", nth).where("r <= 2").select(F.col("group_id").cast("string").alias("instance"), F.when(F.col("r") == 1, "before").otherwise("after").alias("side"), "merge_key")
    bridge = v.t("lineitem").select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("row_key"), (F.col("l_orderkey") % 997).alias("source_id")).distinct()
    return identity.history_parts(m.drop("s_suppkey"), sides, bridge, bar=0.46)


@query("uncertain_rulings", f"""WITH {G}, u AS (SELECT group_id, name, year FROM g WHERE group_id % 4 <> 0), pr AS (SELECT a.group_id, b.group_id AS o FROM u a JOIN u b ON a.name = b.name AND abs(a.year - b.year) <= 1 AND a.group_id <> b.group_id)
  SELECT DISTINCT group_id FROM pr WHERE NOT (abs(group_id - o) % 2 = 0)""")
def _(v):
    g = v.groups().select("group_id", "name", "year", (F.col("group_id") % 4 == 0).alias("anchored"))
    return identity.uncertain_rulings(g, g.select((F.col("group_id") % 2).alias("run"), "group_id"))


@query("held_rows", "SELECT CAST(p_partkey AS VARCHAR) AS row_key, CASE WHEN p_size > 30 THEN CAST(p_partkey AS VARCHAR) ELSE p_brand END AS group_id FROM part")
def _(v):
    p = v.t("part").withColumn("row_key", F.col("p_partkey").cast("string"))
    return identity.with_held(p.where("p_size <= 30").select("row_key", F.col("p_brand").alias("group_id")), p.where("p_size > 30"))


@query("history_splits", f"WITH {M}, s AS (SELECT DISTINCT source_id AS instance, CASE WHEN position % 2 = 0 THEN 'before' ELSE 'after' END AS side, group_id, merge_key FROM m) SELECT group_id % 20 AS group_id, instance FROM s GROUP BY 1, 2 HAVING count(DISTINCT side) = 2")
def _(v):
    m = v.mentions()
    key = F.concat_ws("@", "merge_key", F.col("group_id").cast("string"))
    sides = m.select(F.col("source_id").alias("instance"), F.when(F.col("position") % 2 == 0, "before").otherwise("after").alias("side"), key.alias("merge_key")).distinct()
    return identity.history_split(m.select((F.col("group_id") % 20).alias("group_id"), key.alias("merge_key")).distinct(), sides)


# --- origin, groups and edges

KEYS3 = f"""{M}, x AS (SELECT DISTINCT '' || year || '|' || vol || '|' || {NK.format('abbr')} || '||' || page AS merge_key, {NK.format('abbr')} AS code, CAST(vol AS INTEGER) AS v, year AS y FROM m)"""


def _reporter_rows(v):
    return v.mentions().select("merge_key", F.lit("reporter").alias("citation_kind"), F.lit(False).alias("court_designation_conflict"), F.col("flag").alias("observed_deciding_court")).distinct()


@query("reporter_origin", f"""WITH {KEYS3}, h AS (SELECT merge_key, code >= 'brand2' AND v <= 3 AS a, code < 'brand3' AND y >= 1995 AS b FROM x) SELECT merge_key, CASE WHEN a AND b THEN NULL WHEN a THEN 'GB' ELSE 'US' END AS origin_country, CASE WHEN a AND NOT b THEN 'London' ELSE '' END AS origin_subdivision, CASE WHEN a AND b THEN 'exclusive_reporter_scope_ambiguous' ELSE '' END AS ambiguous_basis FROM h WHERE a OR b""")
def _(v):
    codes = v.t("part").select(fn.nk("p_brand").alias("code"), F.col("p_brand").alias("abbreviation")).distinct()
    n = lambda x: F.lit(x).cast("int")
    rule = lambda where, country, sub, tier, vt, yf: codes.where(where).select("code", "abbreviation", F.lit(country).alias("origin_country"), F.lit(sub).alias("origin_subdivision"), F.lit(tier).alias("exclusivity"), F.lit(f"verified_{tier}").alias("verification_status"), n(None).alias("vol_from"), n(vt).alias("vol_to"), n(yf).alias("year_from"), n(None).alias("year_to"))
    rules = rule("code >= 'brand2'", "GB", "London", "exclusive_statute", 3, None).unionByName(rule("code < 'brand3'", "US", "", "exclusive_publisher", None, 1995)).unionByName(rule("code < 'brand9'", "FR", "", "estimated", None, None))
    return decide.reporter_origin(_reporter_rows(v), rules).drop("evidence")


@query("not_domestic", f"""WITH {KEYS3}, f AS (SELECT DISTINCT merge_key, flag FROM m), h AS (SELECT x.merge_key, max(CASE WHEN y >= 1997 THEN 1 ELSE 0 END) AS a, max(CASE WHEN flag = 'R' AND v >= 4 THEN 1 ELSE 0 END) AS b FROM x JOIN f USING (merge_key) GROUP BY 1)
  SELECT merge_key, 'NOT_DOMESTIC' AS member_origin_status, CASE WHEN a = 1 THEN 'not_domestic_window' ELSE 'not_domestic_printed_court' END AS member_origin_basis FROM h WHERE a = 1 OR b = 1""")
def _(v):
    codes = v.t("part").select(fn.nk("p_brand").alias("code")).distinct()
    n = lambda x: F.lit(x).cast("int")
    rule = lambda no, kind, vf, yf, courts: codes.select("code", F.lit(no).alias("rule_no"), F.lit(kind).alias("exclusivity"), F.lit("verified_not_domestic").alias("verification_status"), F.lit(courts).alias("qualifying_printed_courts"), n(vf).alias("vol_from"), n(None).alias("vol_to"), n(yf).alias("year_from"), n(None).alias("year_to"))
    return decide.not_domestic(_reporter_rows(v), rule(1, "not_domestic_window", None, 1997, "").unionByName(rule(2, "not_domestic_printed_court", 4, None, "Q|R")))


@query("classified_origin", f"""WITH {KEYS3}, k AS (SELECT DISTINCT x.*, CASE WHEN supp % 3 = 0 THEN 'CA' WHEN supp % 3 = 1 THEN 'UNSUPPORTED' ELSE 'XX' END AS j FROM x JOIN m USING (merge_key)), b AS (SELECT merge_key, code < 'brand2' AND y <= 1993 AS held, j, code FROM k WHERE v > 0)
  SELECT DISTINCT merge_key, CASE WHEN held THEN NULL WHEN j = 'CA' THEN 'CA' WHEN j = 'UNSUPPORTED' AND code >= 'brand4' THEN 'GB' END AS origin_country, CASE WHEN held THEN 'mixed_reporter_scope' WHEN j = 'CA' THEN 'classification_jurisdiction' ELSE 'classification_reporter_consensus' END AS basis FROM b WHERE held OR j = 'CA' OR (j = 'UNSUPPORTED' AND code >= 'brand4')""")
def _(v):
    k = F.col("supp") % 3
    rows = v.mentions().select("merge_key", F.lit("reporter").alias("citation_kind"), F.lit("").alias("rejected_reason"), F.when(k == 0, "CA").when(k == 1, "UNSUPPORTED").otherwise("XX").alias("jurisdiction"))
    codes = v.t("part").select(fn.nk("p_brand").alias("code")).distinct()
    n = lambda x: F.lit(x).cast("int")
    mixed = codes.where("code < 'brand2'").select("code", n(None).alias("vol_from"), n(None).alias("vol_to"), n(None).alias("year_from"), n(1993).alias("year_to"))
    agreed = decide.reporter_consensus(codes.where("code >= 'brand4'").withColumn("country", F.lit("GB")).unionByName(codes.where("code < 'brand4'").withColumn("country", F.when(F.col("code") < "brand3", "GB").otherwise(""))).unionByName(codes.where("code < 'brand4'").withColumn("country", F.lit("US"))))
    return decide.classified_origin(rows, v.spark.createDataFrame([("CA", "CA")], "jurisdiction string, country string"), mixed, agreed)


@query("cross_court", f"WITH {M} SELECT group_id, count(DISTINCT source_id) AS dd, count(*) AS occ FROM m GROUP BY 1")
def _(v):
    m = v.mentions().select("group_id", "source_id", "flag")
    return decide.cross_court([m.where(F.col("flag") == f) for f in "ANR"]).groupBy("group_id").agg(F.count_distinct("source_id").alias("dd"), F.count(F.lit(1)).alias("occ"))


def _unique_members(v):
    key = F.concat_ws("#", "merge_key", F.col("group_id").cast("string"))
    return v.mentions().groupBy("group_id", key.alias("merge_key")).agg(F.count(F.lit(1)).alias("occurrence_count"), F.min("name").alias("case_name_modal"))


ADJUDICATED = f"""{M}, o AS (SELECT DISTINCT source_id, merge_key FROM m WHERE {OWN}), e AS (SELECT m.group_id, m.source_id, bool_or(l_orderkey % 10 = 0) AS x, bool_and(o.merge_key IS NOT NULL) AS self FROM m LEFT JOIN o ON m.source_id = o.source_id AND m.merge_key = o.merge_key GROUP BY 1, 2),
  k AS (SELECT group_id, merge_key || '#' || group_id AS key, count(*) AS occ FROM m GROUP BY 1, 2), q AS (SELECT group_id, min(key) AS f, arg_min(key, (-occ, key)) AS primary_key, CAST(sum(occ) AS BIGINT) AS occurrence_count FROM k GROUP BY 1), d AS (SELECT group_id, count(*) AS dd FROM e WHERE NOT x AND NOT self GROUP BY 1)"""


@query("adjudicated_groups", f"WITH {ADJUDICATED} SELECT group_id, 'XC-G' || lpad(CAST(row_number() OVER (ORDER BY f) AS VARCHAR), 6, '0') AS merged_group_id, primary_key, occurrence_count, coalesce(dd, 0) AS distinct_decisions_count FROM q LEFT JOIN d USING (group_id)")
def _(v):
    return decide.adjudicate(_unique_members(v), decide.effective_sources(_bridge(v), _own(v), v.mentions().where("l_orderkey % 10 = 0")))


@query("decide_invariants", "SELECT true AS occurrences_kept, true AS groups_kept, true AS dd_within_occ")
def _(v):
    members = _unique_members(v)
    return decide.decide_invariants(members, decide.adjudicate(members, decide.effective_sources(_bridge(v), _own(v), v.mentions().where("l_orderkey % 10 = 0"))))


@query("edge_origin", f"""WITH {M}, a AS (SELECT source_id, group_id, min(CASE WHEN flag = 'A' THEN 'CA' WHEN flag = 'R' AND qty > 25 THEN 'US' END) AS lo, max(CASE WHEN flag = 'A' THEN 'CA' WHEN flag = 'R' AND qty > 25 THEN 'US' END) AS hi, bool_and(qty > 5) AS s FROM m GROUP BY 1, 2)
  SELECT source_id, group_id, CASE WHEN lo <> hi THEN 'CONFLICT' WHEN lo = 'CA' THEN 'DOMESTIC_CA' WHEN lo = 'US' THEN 'FOREIGN' WHEN s AND group_id % 2 = 0 THEN 'FOREIGN' ELSE 'UNDETERMINED' END AS foreign_status, CASE WHEN lo <> hi THEN NULL WHEN lo IS NOT NULL THEN lo WHEN s AND group_id % 2 = 0 THEN 'GB' END AS origin_country, CASE WHEN lo IS NOT NULL THEN 'member' WHEN s THEN 'group' ELSE '' END AS origin_basis FROM a""")
def _(v):
    m = v.mentions()
    country = F.when(F.col("flag") == "A", "CA").when((F.col("flag") == "R") & (F.col("qty") > 25), "US")
    seen = m.select("source_id", "group_id", (F.col("qty") > 5).alias("supported"), country.alias("member_origin_country"), F.when(country.isNotNull(), "DETERMINED").otherwise("UNDETERMINED").alias("member_origin_status"))
    groups = m.select("group_id").distinct().select("group_id", F.when(F.col("group_id") % 2 == 0, "FOREIGN").otherwise("UNDETERMINED").alias("group_foreign_status"), F.when(F.col("group_id") % 2 == 0, "GB").alias("group_origin_country"))
    return decide.edge_origin(seen, groups, ["source_id", "group_id"])


# --- questions, quality and stored judgments


@query("relation_counts", f"WITH {E} SELECT CASE WHEN mention_count > 1 THEN 'same_case_history' ELSE 'other_judgment' END AS relation, count(*) AS pairs FROM e GROUP BY 1")
def _(v):
    return an.relation_summary(v.edges().select("source_id", "group_id", F.when(F.col("mention_count") > 1, "same_case_history").otherwise("other_judgment").alias("relation")))


@query("show_case", f"WITH {E} SELECT g.group_id, g.dd, g.name, CASE WHEN edge_support = 'supported' THEN 'history' ELSE 'other_judgment' END AS relation, count(*) AS citing FROM e JOIN g USING (group_id) WHERE group_id = 7 GROUP BY 1, 2, 3, 4")
def _(v):
    e = v.edges()
    return an.show_case(v.groups().select("group_id", "dd", "name"), e, e.where("edge_support = 'supported'").select("source_id", "group_id", F.lit("history").alias("relation")), 7)


@query("cached_vectors", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CAST(n_chars AS VARCHAR) END AS vector, sha256(text) AS sha FROM documents WHERE text IS NOT NULL")
def _(v):
    d = v.t("documents").where("text is not null").select("doc_id", "text", "n_chars")
    cache = d.where("doc_id % 3 = 0").select(F.sha2("text", 256).alias("sha"), F.col("n_chars").alias("vector"), "doc_id").drop("doc_id").distinct()
    texts = d.select(F.concat_ws("", F.col("text")).alias("text"), "doc_id", "n_chars")
    out = an.cached_vectors(texts, cache)
    # equal texts share a hash: a text is a hit when any of its copies was stored
    return out.select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.col("vector").cast("string")).alias("vector"), "sha")


@query("numbered_repeats", f"WITH {M} SELECT merge_key, source_id, position, CAST(row_number() OVER (PARTITION BY merge_key ORDER BY source_id, position) AS INTEGER) AS ordinal FROM m")
def _(v):
    return quality.with_ordinal(v.mentions(), "merge_key", ["source_id", "position"]).select("merge_key", "source_id", "position", "ordinal")


@query("reassessed", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 = 0 THEN 'GB' WHEN p_size % 2 = 0 THEN NULL ELSE 'CA' END AS country, CASE WHEN p_size % 2 = 0 AND p_partkey % 3 > 0 THEN 'UNDETERMINED' ELSE 'DETERMINED' END AS status FROM part")
def _(v):
    key = F.col("p_partkey").cast("string")
    even = F.col("p_size") % 2 == 0
    g = v.t("part").select("p_partkey", key.alias("merge_key"), F.when(~even, "CA").alias("member_origin_country"), F.when(even, "UNDETERMINED").otherwise("DETERMINED").alias("member_origin_status"))
    seen = v.t("part").where("p_partkey % 3 = 0").select(key.alias("merge_key"), F.lit("GB").alias("origin_country"))
    return quality.reassess(g, seen).select("p_partkey", F.col("member_origin_country").alias("country"), F.col("member_origin_status").alias("status"))


@query("matched_groups", """WITH g AS (SELECT p_name, p_brand, count(*) FILTER (p_size >= 45) AS gone, count(DISTINCT CASE WHEN p_size < 45 THEN p_size > 30 END) AS k, bool_or(p_size <= 30) AS low FROM part GROUP BY 1, 2)
  SELECT CASE WHEN k = 0 THEN 'o:' || p_name || '/' || p_brand WHEN low THEN 'n:' || p_name || '/' || p_brand || '/' ELSE 'n:' || p_name || '/' || p_brand || '/x' END AS component, CAST(1 AS BIGINT) AS old_groups, k AS new_groups, CASE WHEN k = 0 THEN 'old_only' WHEN k = 2 THEN 'split' WHEN gone > 0 THEN 'one_to_one_changed' ELSE 'one_to_one_same' END AS change FROM g""")
def _(v):
    p = v.t("part")
    old = p.select(F.col("p_partkey").alias("member"), F.concat_ws("/", "p_name", "p_brand").alias("group_id"))
    return quality.match_groups(old, p.where("p_size < 45").select(F.col("p_partkey").alias("member"), F.concat_ws("/", "p_name", "p_brand", F.when(F.col("p_size") > 30, F.lit("x")).otherwise("")).alias("group_id")))


@query("type_scope", "WITH h AS (SELECT p_partkey, ('0x' || substring(md5('s|' || p_partkey), 1, 8))::BIGINT / 4294967296.0 AS u, p_size FROM part) SELECT p_partkey, CASE WHEN p_size < 10 THEN 'unsupported' ELSE 'audit' END AS scope FROM h WHERE p_size < 10 OR u < 0.3")
def _(v):
    p = v.t("part").select("p_partkey", F.col("p_partkey").cast("string").alias("candidate_id"), F.when(F.col("p_size") < 10, "UNSUPPORTED").otherwise("CA").alias("jurisdiction"), F.lit("").alias("rejected_reason"))
    return scorer.type_scope(p, 0.3, "s").select("p_partkey", "scope")


@query("name_options", "SELECT p_partkey, 'Alpha,Beta v. Brand' || p_size AS options FROM part")
def _(v):
    pre = F.concat(F.lit("so said Alpha in; and by Beta v. Brand"), F.col("p_size").cast("string"), F.lit(" , "))
    return v.t("part").select("p_partkey", F.array_join(scorer.name_options(pre, 2), ",").alias("options"))


@query("judged_rows", "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'yes' ELSE '' END AS history_model, p_type AS rule_type, CASE WHEN p_size > 40 THEN 'new' END AS model_type FROM part")
def _(v):
    p = v.t("part").select("p_partkey", F.col("p_type").alias("type"), "p_size")
    judged = p.select("p_partkey", F.when(F.col("p_size") > 40, "adopt").otherwise("review").alias("decision"))
    rows = scorer.apply_judgments(p, judged, "p_partkey", "history_model", "yes")
    return scorer.post_pass(rows, p.where("p_size > 40").select("p_partkey", F.lit("new").alias("type")), ["type"], "p_partkey").select("p_partkey", "history_model", "rule_type", "model_type")


@query("date_corroboration", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'not_asked' WHEN o_orderkey % 3 = 1 OR year(o_orderdate) = 1995 THEN CASE WHEN o_orderkey % 3 = 1 OR year(o_orderdate) = 1995 THEN 'corroborates' END ELSE 'contradicts' END AS status FROM orders")
def _(v):
    o = v.t("orders").select("o_orderkey", F.concat(F.lit("s"), F.col("o_orderkey").cast("string")).alias("source_id"), F.year("o_orderdate").alias("provider_decision_year"), F.col("o_orderdate").cast("date").alias("d"))
    judged = o.where("o_orderkey % 3 <> 0").select("source_id", F.when(F.col("o_orderkey") % 3 == 1, F.col("d")).otherwise(F.lit("1995-06-01").cast("date")).alias("model_native_date"), F.lit(0.9).alias("model_date_p"))
    return scorer.date_corroboration(o, judged).select("o_orderkey", F.col("model_date_status").alias("status"))


# --- zones

ZONES = """z AS (SELECT page_id, html, strpos(html, '<article>') - 1 AS r, strpos(html, '<nav>') - 1 AS n FROM pages), f AS (SELECT *, CASE WHEN n >= 0 AND n < r THEN n END AS b FROM z),
  g AS (SELECT *, CASE WHEN b IS NOT NULL THEN strpos(substring(html, b + 6), '<nav>') END AS n2, CASE WHEN b IS NOT NULL THEN strpos(substring(html, b + 6), '</nav>') END AS c FROM f), h AS (SELECT *, CASE WHEN n2 > 0 AND b + 4 + n2 < r THEN b + 4 + n2 ELSE r END AS lim FROM g)"""


@query("document_zones", f"WITH {ZONES} SELECT page_id, CASE WHEN r >= 0 THEN 'located' ELSE 'no_verified_boundary' END AS status, CAST(r AS INTEGER) AS reasons_start, coalesce(b || ':' || CASE WHEN c > 0 AND b + 4 + c <= lim THEN b + 4 + c ELSE lim END, '') AS first_appeal FROM h")
def _(v):
    z = integrity.locate_zones(v.t("pages"), [(r"<article>", "reasons_delivery"), (r"<nav>", "appeal_start"), (r"</nav>", "appeal_end")], "page_id", "html")
    first = F.get("appeal_spans", 0)
    return z.select("page_id", "status", "reasons_start", F.coalesce(F.concat(first["start"].cast("string"), F.lit(":"), first["end"].cast("string")), F.lit("")).alias("first_appeal"))

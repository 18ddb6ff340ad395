"""Registered queries of operators that read documents: texts printed from the star-schema tables, so that SQL knows what is in them.

Every order is a document whose line items are its citations: returned ones (A) as a
neutral citation, (R) as a reporter of the same year, others as a reporter without a
year, of another country or of none that a table knows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions import scalar as fn
from citeloom.operators import analytics as an
from citeloom.operators import classify, decide, extract, integrity, quality
from citeloom.operators.shapes import ShapeSet
from citeloom.plans.catalog import query
from citeloom.plans.run import Run, key_table, read_citations, run
from citeloom.plans.views import M
from citeloom.sources import corpus
from citeloom.staging import staged

# --- whole runs

#: The letters of a part's number, so that names hold no digits.
NAME = "'Ca' || translate(CAST(l_partkey AS VARCHAR), '0123456789', 'abcdefghij') || ' v. Meridian'"
PRINTED = f"""p AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 'A' WHEN l_returnflag = 'R' THEN 'R' WHEN l_linenumber % 2 = 0 THEN 'Z' ELSE 'U' END AS f,
  CASE WHEN l_returnflag = 'A' THEN '2019 ONCA ' || l_partkey WHEN l_returnflag = 'R' THEN '[2019] 2 S.C.R. ' || l_partkey WHEN l_linenumber % 2 = 0 THEN '53 Z.Z.R. ' || l_partkey ELSE '410 U.S. ' || l_partkey END AS raw,
  CASE WHEN l_returnflag = 'A' THEN '2019||onca||' || l_partkey WHEN l_returnflag = 'R' THEN '2019|2|scr||' || l_partkey WHEN l_linenumber % 2 = 0 THEN '|53|zzr||' || l_partkey ELSE '|410|us||' || l_partkey END AS k,
  'SCC_2020scc' || l_orderkey AS source_id FROM lineitem),
  kk AS (SELECT DISTINCT k, f, l_partkey FROM p), both_ AS (SELECT l_partkey FROM kk WHERE f IN ('A', 'R') GROUP BY 1 HAVING count(*) = 2),
  gr AS (SELECT k, CASE WHEN f IN ('A', 'R') AND l_partkey IN (SELECT l_partkey FROM both_) THEN '2019|2|scr||' || l_partkey ELSE k END AS group_id FROM kk)"""


def _documents(v) -> DataFrame:
    n = F.col("l_partkey").cast("string")
    flag, odd = F.col("l_returnflag"), F.col("l_linenumber") % 2 == 1
    cite = F.concat(F.when(flag == "A", "2019 ONCA ").when(flag == "R", "[2019] 2 S.C.R. ").when(odd, "410 U.S. ").otherwise("53 Z.Z.R. "), n)
    line = F.concat(F.lit("["), F.col("l_linenumber").cast("string"), F.lit("] Ca"), F.translate(n, "0123456789", "abcdefghij"), F.lit(" v. Meridian, "), cite, F.lit("."))
    body = v.t("lineitem").select("l_orderkey", "l_linenumber", line.alias("line")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "line"))).alias("lines"))
    own = F.concat(F.lit("2020 SCC "), F.col("l_orderkey").cast("string"))
    text = F.concat(F.lit("Neutral citation\n"), own, F.lit("\nReasons for Judgment\n"), F.array_join(F.transform("lines", lambda x: x["line"]), "\n"))
    return body.select(F.lit("SCC").alias("court"), F.col("l_orderkey").alias("corpus_row_index"), own.alias("citation"), F.lit(2020).alias("year"), text.alias("text"))


def _tables(v) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Courts, reporters and countries that the printed citations name."""
    make = v.spark.createDataFrame
    courts = make([("SCC", "CA"), ("ONCA", "CA")], "court_code string, jurisdiction string")
    reporters = make([("S.C.R.", "CA", "confirmed", None, None, 1923, None), ("U.S.", "US", "confirmed", None, None, None, None)], "abbreviation string, jurisdiction string, confidence string, vol_from int, vol_to int, year_from int, year_to int")
    return courts, reporters, make([("CA", "CA"), ("US", "US")], "jurisdiction string, country string")


def _run(v) -> Run:
    return run(_documents(v), *_tables(v), keep=())


def _ledger(v, *keep: str) -> DataFrame:
    """The run's ledger, without the steps after it and with the named columns only."""
    return read_citations(_documents(v), *_tables(v)[:2], keep=keep)


@query("run_statuses", f"WITH {PRINTED} SELECT 'counted' AS arbitration_status, count(*) AS n, count(DISTINCT source_id) AS sources FROM p UNION ALL SELECT 'self_citation_row', 2 * count(DISTINCT l_orderkey), count(DISTINCT source_id) FROM p")
def _(v):
    led = _ledger(v, "source_id").where("arbitration_status in ('counted', 'self_citation_row')")
    return led.groupBy("arbitration_status").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source_id").alias("sources"))


@query("run_mentions", f"WITH {PRINTED} SELECT source_id, raw AS raw_string, k AS merge_key, {NAME} AS candidate_case_name, CASE f WHEN 'A' THEN 'neutral' ELSE 'reporter' END AS citation_kind, CASE f WHEN 'Z' THEN 'UNSUPPORTED' WHEN 'U' THEN 'US' ELSE 'CA' END AS jurisdiction FROM p")
def _(v):
    told = ("source_id", "raw_string", "merge_key", "candidate_case_name", "citation_kind", "jurisdiction")
    return _ledger(v, *told).where("arbitration_status = 'counted'").select(*told)


@query("run_keys", f"WITH {PRINTED} SELECT k AS merge_key, count(*) AS occurrence_count, count(DISTINCT source_id) AS distinct_decisions_count, {NAME} AS case_name_modal FROM p GROUP BY k, l_partkey")
def _(v):
    read = ("merge_key", "candidate_case_name", "source_decision_year", "citation_kind", "jurisdiction", "rejected_reason")
    return key_table(staged(_ledger(v, *read).where("arbitration_status = 'counted'"), "counted-mentions")).select("merge_key", "occurrence_count", "distinct_decisions_count", "case_name_modal")


@query("run_members", f"WITH {PRINTED} SELECT k AS merge_key, group_id, CASE WHEN count(*) OVER (PARTITION BY group_id) = 1 THEN 'singleton' WHEN k = group_id THEN 'anchor' ELSE 'name_year' END AS identity_basis, CASE WHEN k LIKE '|53|%' THEN 'UNDETERMINED' ELSE 'DETERMINED' END AS member_origin_status, CASE WHEN k LIKE '|410|%' THEN 'US' WHEN k NOT LIKE '|53|%' THEN 'CA' END AS member_origin_country FROM gr")
def _(v):
    return _run(v).members.select("merge_key", "group_id", "identity_basis", "member_origin_status", "member_origin_country")


@query("run_groups", f"WITH {PRINTED} SELECT 'XC-G' || lpad(CAST(row_number() OVER (ORDER BY min(k)) AS VARCHAR), 6, '0') AS merged_group_id, group_id, count(*) AS occurrence_count, count(DISTINCT source_id) AS dd, CASE WHEN group_id LIKE '|410|%' THEN 'FOREIGN' WHEN group_id LIKE '|53|%' THEN 'UNDETERMINED' ELSE 'DOMESTIC_CA' END AS group_foreign_status FROM p JOIN gr USING (k) GROUP BY group_id")
def _(v):
    return _run(v).groups.select("merged_group_id", "group_id", "occurrence_count", "dd", "group_foreign_status")


@query("run_edges", f"WITH {PRINTED}, e AS (SELECT source_id, group_id, count(*) AS mention_count, bool_or(k = group_id) AS anchored FROM p JOIN gr USING (k) GROUP BY 1, 2) SELECT source_id, group_id, mention_count, CASE WHEN anchored THEN 'supported' ELSE 'heuristic_only' END AS edge_support, CASE WHEN group_id LIKE '|410|%' THEN 'FOREIGN' WHEN group_id LIKE '|53|%' THEN 'UNDETERMINED' ELSE 'DOMESTIC_CA' END AS group_foreign_status FROM e")
def _(v):
    return _run(v).edges.select("source_id", "group_id", "mention_count", "edge_support", "group_foreign_status")


@query("run_trace", f"WITH {PRINTED} SELECT true AS agrees, count(*) AS n FROM p")
def _(v):
    docs = _documents(v).select("court", "corpus_row_index", F.col("text").alias("unofficial_text"))
    return corpus.trace(_ledger(v, "court", "corpus_row_index", "match_start_offset", "match_end_offset", "raw_string").where("arbitration_status = 'counted'"), docs).groupBy("agrees").agg(F.count(F.lit(1)).alias("n"))


@query("candidate_search", f"WITH {PRINTED} SELECT raw AS raw_string, l_orderkey AS corpus_row_index FROM p WHERE contains(raw, 'Z.Z.R. 1') ORDER BY l_orderkey, l_linenumber LIMIT 40")
def _(v):
    led = _ledger(v, "court", "corpus_row_index", "match_start_offset", "match_end_offset", "shape_name", "raw_string", "candidate_case_name").where("arbitration_status = 'counted'")
    return corpus.search_candidates(led, "z.z.r. 1").select("raw_string", "corpus_row_index")


@query("evidence_packet", f"WITH {PRINTED} SELECT source_id, raw AS raw_string, true AS inside, n FROM (SELECT *, row_number() OVER (PARTITION BY source_id, k ORDER BY l_linenumber) AS n FROM p) WHERE n = 1")
def _(v):
    m = _ledger(v, "merge_key", "match_start_offset", "match_end_offset", "raw_string").where("arbitration_status = 'counted'").withColumnRenamed("merge_key", "group_id")
    m = staged(m, "counted-mentions")  # read for the edges and for their mentions
    texts = _documents(v).select(F.concat(F.lit("SCC_"), fn.nk("citation")).alias("source_id"), "text")
    e = an.evidence_packet(m.select("source_id", "group_id").distinct(), m, texts)
    return e.select("source_id", "raw_string", F.expr("instr(window, raw_string) > 0").alias("inside"), F.lit(1).cast("long").alias("n"))


@query("review_packet", f"WITH {PRINTED} SELECT source_id, '[' || l_linenumber || '] ' || {NAME} || ', ' || raw || '.' AS paragraph FROM p WHERE l_linenumber = 3")
def _(v):
    m = _ledger(v, "match_start_offset").where("arbitration_status = 'counted'").select("source_id", "match_start_offset")
    texts = _documents(v).select(F.concat(F.lit("SCC_"), fn.nk("citation")).alias("source_id"), "text")
    return quality.review_packet(m, texts).where("paragraph like '[3]%'").select("source_id", "paragraph")


@query("arbitration_groups", f"WITH {PRINTED} SELECT 'counted' AS bucket, count(*) AS n FROM p UNION ALL SELECT 'self', 2 * count(DISTINCT l_orderkey) FROM p")
def _(v):
    led = _ledger(v, "source_id").select(an.arbitration_group(F.col("arbitration_status")).alias("bucket"))
    return led.where("bucket in ('counted', 'self')").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("source_titles", "SELECT 'SCC_2020scc' || o_orderkey AS decision_id, o_orderstatus || ' v. ' || o_orderpriority AS title FROM orders WHERE o_custkey % 4 = 0")
def _(v):
    o = v.t("orders")
    docs = o.select(F.lit("SCC").alias("court"), F.concat(F.lit("2020 SCC "), F.col("o_orderkey").cast("string")).alias("citation"), F.concat("o_orderstatus", F.lit(" v. "), "o_orderpriority").alias("name"))
    return decide.source_titles(docs, o.where("o_custkey % 4 = 0").select(F.concat(F.lit("SCC_2020scc"), F.col("o_orderkey").cast("string")).alias("decision_id")))


# --- headers

HEADED = """h AS (SELECT o_orderkey, o_orderkey % 6 AS c, 'Decision Content' || chr(10) || CASE o_orderkey % 6 WHEN 0 THEN 'CITATION: 2020 SCC ' || (o_orderkey + 1) || chr(10) || 'DATE: 20200105' || chr(10) || 'JUDGES: X' WHEN 1 THEN 'CITATION: 2020 SCC 99999999' || chr(10) || 'JUDGES: X' WHEN 2 THEN 'DATE: 2020-01-05' || chr(10) || 'DATE: 2020-01-06' || chr(10) || 'JUDGES: X'
  WHEN 3 THEN 'CITATION: none 7' || chr(10) || 'DATE: 2020-02-31' || chr(10) || 'JUDGES: X' WHEN 4 THEN '2020 SCC ' || (o_orderkey + 1) || chr(10) || 'The Honourable Justice Jones' ELSE 'plain words' END || CASE WHEN o_orderkey % 6 = 4 THEN '' ELSE chr(10) || '[1] Body' || chr(10) || 'DATE: 20210101' END AS text FROM orders)"""


def _headed(v) -> DataFrame:
    n, c, nl = (F.col("o_orderkey") + 1).cast("string"), F.col("o_orderkey") % 6, "\n"
    body = F.when(c == 0, F.concat(F.lit("CITATION: 2020 SCC "), n, F.lit(f"{nl}DATE: 20200105{nl}JUDGES: X"))).when(c == 1, f"CITATION: 2020 SCC 99999999{nl}JUDGES: X").when(c == 2, f"DATE: 2020-01-05{nl}DATE: 2020-01-06{nl}JUDGES: X")
    body = body.when(c == 3, f"CITATION: none 7{nl}DATE: 2020-02-31{nl}JUDGES: X").when(c == 4, F.concat(F.lit("2020 SCC "), n, F.lit(f"{nl}The Honourable Justice Jones"))).otherwise("plain words")
    text = F.concat(F.lit(f"Decision Content{nl}"), body, F.when(c == 4, "").otherwise(f"{nl}[1] Body{nl}DATE: 20210101"))
    return v.t("orders").select("o_orderkey", "o_orderdate", text.alias("text"), F.concat(F.lit("2020 SCC "), n).alias("citation"))


@query("header_region", f"WITH {HEADED} SELECT o_orderkey, trim(regexp_replace(regexp_replace(text, '^Decision Content', ''), '\\[1\\].*$', '', 's'), ' ' || chr(10)) AS header FROM h")
def _(v):
    return _headed(v).select("o_orderkey", F.regexp_replace(integrity.header_region(F.col("text")), r"^\s+|\s+$", "").alias("header"))


@query("native_dates", f"WITH {HEADED} SELECT o_orderkey, CASE WHEN c = 0 THEN '2020-01-05' END AS day, CASE c WHEN 0 THEN 'RESOLVED' WHEN 2 THEN 'AMBIGUOUS_DATES' WHEN 3 THEN 'INVALID_DATE' ELSE 'NO_FORMAL_DATE' END AS status, CASE WHEN c = 0 THEN '2020' END AS year, CASE WHEN c = 0 THEN 'native' ELSE 'unknown' END AS basis FROM h")
def _(v):
    d = _headed(v).select("o_orderkey", integrity.native_date(F.col("text"), F.lit(None).cast("date")).alias("d"))
    return d.select("o_orderkey", F.col("d.date").cast("string").alias("day"), "d.status", F.col("d.year").cast("string").alias("year"), "d.basis")


@query("provider_dates", f"WITH {HEADED} SELECT h.o_orderkey, CASE WHEN c = 0 AND year(o_orderdate) >= 2019 THEN CASE WHEN year(o_orderdate) = 2020 THEN 'AGREES' ELSE 'CONFLICT' END ELSE 'NOT_COMPARED' END AS conflict, CASE c WHEN 0 THEN CASE WHEN year(o_orderdate) >= 2019 THEN 'RESOLVED' ELSE 'OUT_OF_RANGE' END WHEN 2 THEN 'AMBIGUOUS_DATES' WHEN 3 THEN 'INVALID_DATE' ELSE 'NO_FORMAL_DATE' END AS status FROM h JOIN orders USING (o_orderkey)")
def _(v):
    d = _headed(v).select("o_orderkey", integrity.native_date(F.col("text"), F.col("o_orderdate").cast("date")).alias("d"))
    return d.select("o_orderkey", "d.conflict", "d.status")


@query("own_citations_checked", f"WITH {HEADED} SELECT o_orderkey, CASE c WHEN 0 THEN 'MATCH' WHEN 1 THEN 'MALFORMED' WHEN 3 THEN 'MALFORMED' ELSE 'NO_VERIFIED_CITATION' END AS own FROM h")
def _(v):
    return _headed(v).select("o_orderkey", integrity.own_citation(F.col("text"), F.col("citation")).alias("own"))


@query("text_integrity", f"WITH {HEADED} SELECT CASE c WHEN 4 THEN 'INCOMPLETE_HEADER_SIGNATURE' ELSE 'PRESENT_UNVERIFIED' END AS integrity, count(*) AS n FROM h GROUP BY 1")
def _(v):
    return _headed(v).select(integrity.text_integrity(F.col("text"), F.lit(""), F.col("citation")).alias("integrity")).groupBy("integrity").agg(F.count(F.lit(1)).alias("n"))


@query("neutral_keys", "SELECT o_orderkey, '2019:onca:' || (o_orderkey + 1) AS first_key, 2 AS keys FROM orders")
def _(v):
    n = (F.col("o_orderkey") + 1).cast("string")
    k = integrity.neutral_keys(F.concat(F.lit("see 2019 ONCA "), n, F.lit(", 2020 SCC 0, 1999 C.S.C. "), n, F.lit(" x2019 AB 3")), F.create_map(F.lit("csc"), F.lit("scc")))
    return v.t("orders").select("o_orderkey", F.get(k, 0).alias("first_key"), F.size(k).alias("keys"))


@query("header_dates", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ',1979-03-04' AS days FROM orders")
def _(v):
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    days = fn.header_dates(F.concat(F.lit("DATE: "), d, F.lit("\nHeard: March 4, 1979; "), d, F.lit("; 2001-02-31")))
    return v.t("orders").select("o_orderkey", F.array_join(F.transform(days, lambda x: x.cast("string")), ",").alias("days"))


@query("kept_instances", f"WITH {M} SELECT DISTINCT supp, source_id FROM m WHERE supp NOT IN (SELECT supp FROM m WHERE l_orderkey % 50 = 0)")
def _(v):
    m = v.mentions()
    return integrity.filter_instances(m.select("supp", "source_id").distinct(), m.where("l_orderkey % 50 = 0"), "supp")


# --- scalar functions on columns

@query("context_tokens", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE array_to_string(list_sort(list_distinct(list_filter(string_split(lower(p_name) || ' meridian', ' '), lambda w: length(w) >= 3))), ',') END AS tokens FROM part")
def _(v):
    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.concat("p_name", F.lit(" v. Méridian Ltd."))).otherwise(F.concat(F.lit("The Meridian c. "), F.col("p_name")))
    return v.t("part").select("p_partkey", F.array_join(fn.case_context_tokens(name), ",").alias("tokens"))


@query("years_of_ids", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(year(o_orderdate) AS INTEGER) AS s, CASE WHEN year(o_orderdate) < 1950 THEN 'before 1950' WHEN year(o_orderdate) < 1982 THEN '1950-1981' WHEN year(o_orderdate) < 2000 THEN '1982-1999' ELSE '2000 on' END AS era, 'strasse ' || lower(o_orderpriority) AS folded, contains(o_orderpriority, '-U') AS urgent FROM orders")
def _(v):
    y = F.year("o_orderdate").cast("string")
    return v.t("orders").select(
        "o_orderkey", fn.year_of(F.concat(y, F.lit(" SCC 5"))).alias("y"), fn.source_year(F.concat(F.lit("ONCA_"), y, F.lit("onca77"))).alias("s"), fn.era(F.year("o_orderdate")).alias("era"),
        fn.casefold(F.concat(F.lit("STRAßE "), "o_orderpriority")).alias("folded"), fn.contains_literal("o_orderpriority", "-U").alias("urgent"),
    )


@query("gaps", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN ', ' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE '; and ' END AS gap, p_partkey % 4 = 0 AS parallel FROM part")
def _(v):
    k = F.col("p_partkey") % 4
    g = fn.gap_text(F.lit(10), F.lit(10) + F.when(k == 0, 2).when(k == 1, 0).when(k == 2, 50).otherwise(6), F.when(k == 0, "2 S.C.R. 5, ").otherwise("2 S.C.R. 5; and "))
    return v.t("part").select("p_partkey", g.alias("gap"), fn.parallel_gap(g).alias("parallel"))


@query("hierarchy", "SELECT c_custkey, (c_custkey % 3 = 0 OR c_custkey % 5 = 0) AND NOT (1990 + c_custkey % 7 > 1993) AS eligible FROM customer")
def _(v):
    k = F.col("c_custkey")
    return v.t("customer").select("c_custkey", fn.history_eligible(F.lit("A"), F.when(k % 3 == 0, "A").otherwise("B"), F.lit(1993), 1990 + k % 7, k % 5 == 0).alias("eligible"))


@query("fact_ids", """SELECT p_partkey, sha256('{"a":"' || p_brand || '","b":"' || p_size || '"}') AS id FROM part""")
def _(v):
    return v.t("part").select("p_partkey", fn.fact_id(b=F.col("p_size").cast("string"), a="p_brand").alias("id"))


# --- every printed form, one for each line item

#: Rows of the dimensions that make forms: a registered id, a code glued to year and number, and a locator of two parts.
FORM_ROWS = ShapeSet(
    id_rows=[{"prefix_regex": r"CarswellOnt", "body_regex": r"\s*[-‐]\s*\d+", "canonical_token": "{prefix}"}],
    codes=["TCC"],
    code_digits=19,  # numbers of parts are as long as a long
    locator_rows=[{"abbreviation_regex": r"I\.L\.R\.", "locator_regex": r"1-\d{3,}"}],
)
#: Form by number: how it is printed (v volume, n page, y year) and what its parts say: abbreviation, volume, page, year, series, note.
FORMS = [
    ("shape_vol_page_year", "v || ' D.L.R. (2d) ' || n || ' (' || y || ')'", "'D.L.R.'", "v", "n", "y", "''", "''", "'2d'"),
    ("shape_year_vol_page", "'(' || y || '), ' || v || ' O.R. ' || n", "'O.R.'", "v", "n", "y", "''", "''", "''"),
    ("shape_nominate", "v || ' U.S. (1 Cranch) ' || n || ' (' || y || ')'", "'U.S.'", "v", "n", "y", "''", "'1 Cranch'", "''"),
    ("shape_leading_abbr", "'(' || y || ') Chd ' || v || ' L.J. ' || n", "'L.J.'", "v", "n", "y", "''", "''", "''"),
    ("shape_bracket_range", "'[' || y || '-39] ' || v || ' W.W.R. ' || n", "'W.W.R.'", "v", "n", "y", "''", "''", "''"),
    ("shape_year_vol_page_transposed_series", "'(' || y || '), ' || v || ' O.R. 2(d) ' || n", "'O.R.'", "v", "n", "y", "'2d'", "''", "''"),
    ("shape_vol_abbr_page_transposed_series", "v || ' A.R. 3(d) ' || n", "'A.R.'", "v", "n", "''", "'3d'", "''", "''"),
    ("shape_registered_id", "'CarswellOnt ‐ ' || n", "'CARSWELLONT'", "''", "n", "''", "''", "''", "''"),
    ("shape_neutral_glued", "y || 'TCC' || n", "'TCC'", "''", "n", "y", "''", "''", "''"),
    ("shape_bracket_compound_locator", "'[' || y || '] I.L.R. 1-' || (1000 + n)", "'I.L.R.'", "''", "'1-' || (1000 + n)", "y", "''", "''", "''"),
    ("shape_paren_year_abbr_page", "'(' || y || ') S.C.R. ' || n", "'S.C.R.'", "''", "n", "y", "''", "''", "''"),
]
LINES = "SELECT DISTINCT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey * 10 + l_suppkey % 10 AS doc, l_linenumber AS v, l_partkey AS n, 1800 + (l_partkey * 7 + l_linenumber) % 138 AS y, (l_partkey + l_linenumber) % 11 AS f FROM lineitem"


def _case(i: int) -> str:
    return "CASE f " + " ".join(f"WHEN {k} THEN CAST({form[i]} AS VARCHAR)" for k, form in enumerate(FORMS)) + " END"


FORM_TEXT = f"(CASE f {' '.join(f'WHEN {k} THEN {form[1]}' for k, form in enumerate(FORMS))} END)"
FORM_NAME = f"(CASE f {' '.join(f'WHEN {k} THEN {chr(39)}{form[0]}{chr(39)}' for k, form in enumerate(FORMS))} END)"


@query(
    "printed_forms",
    f"""WITH l AS ({LINES}) SELECT doc, {FORM_NAME} AS shape_name, {FORM_TEXT} AS raw_string, {_case(2)} AS name, {_case(3)} AS vol, {_case(4)} AS page,
  {_case(5)} AS year_start, {_case(6)} AS series, {_case(7)} AS paren_note, {_case(8)} AS series_paren, 4 AS at FROM l WHERE NOT (f = 10 AND n = y)
  UNION ALL SELECT doc, 'shape_leading_abbr', 'Chd ' || v || ' L.J. ' || n, 'L.J.', CAST(v AS VARCHAR), CAST(n AS VARCHAR), '', '', '', '', 11 FROM l WHERE f = 3""",  # its year may be left out; a page of the year's number is no page

)
def _(v):
    v.t("lineitem").createOrReplaceTempView("lineitem_of_forms")
    lines = v.spark.sql(LINES.replace("FROM lineitem", "FROM lineitem_of_forms"))
    text = F.concat(F.lit("see "), F.expr(FORM_TEXT), F.lit(" in full."))
    docs = lines.select(F.lit("SCC").alias("court"), F.col("doc").alias("corpus_row_index"), F.expr(FORM_NAME).alias("citation"), F.lit(2020).alias("year"), text.alias("text"))
    j = extract.extract(docs, FORM_ROWS).where(F.col("source_decision_citation") == F.concat(F.lit("SCC_"), fn.nk("shape_name")))  # each document tells its form, for numbers of documents may meet
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return j.select(F.col("corpus_row_index").alias("doc"), "shape_name", "raw_string", F.coalesce(F.when(F.col("abbr") != "", F.col("abbr")), F.col("token")).alias("name"), *[blank(c).cast("string").alias(c) for c in ("vol", "page", "year_start", "series", "paren_note", "series_paren")], F.col("match_start_offset").alias("at"))


# --- case names before a citation, one for each line item

WHO = "'Ca' || translate(CAST(n AS VARCHAR), '0123456789', 'abcdefghij')"
#: What stands before a citation, the case name that is cut out of it, and why there is none.
NAMED = [
    (f"'Intro.\n[3] the court then relied on ' || {WHO} || ' v. Meridian, '", f"{WHO} || ' v. Meridian'", "''"),
    (f"'Intro.\nSee also ' || {WHO} || ' v. Meridian, '", f"{WHO} || ' v. Meridian'", "''"),
    (f"'Intro.\nOld v. Case, 2001 ABCA 5, ' || {WHO} || ' v. Meridian, '", f"{WHO} || ' v. Meridian'", "''"),
    (f"'Intro.\nBoreal c. Atlas, citant Renvoi sur la loi ' || {WHO} || ', '", f"'Renvoi sur la loi ' || {WHO}", "''"),
    (f"'Intro.\nRe ' || {WHO} || ', '", f"'Re ' || {WHO}", "''"),
    (f"'Intro.\nas the court said in ' || {WHO} || ' Estate (Re), '", f"{WHO} || ' Estate (Re)'", "''"),
    ("'Intro.\nDroit de la famille — ' || n || ', '", "'Droit de la famille — ' || n", "''"),
    (f"{WHO} || ' v. Meridian, '", "''", "'no_separator_before_v'"),
    (f"'Intro.\n' || {WHO} || ' v. Meridian; Another matter, '", "''", "'name_belongs_to_later_segment'"),
    (f"'Intro.\nas decided in ' || {WHO} || ', '", "''", "'no_v_structure'"),
    (f"'Intro.\n' || {WHO} || ' v. Meridian (1999), '", f"{WHO} || ' v. Meridian'", "''"),
]
NAME_LINES = "SELECT DISTINCT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey * 10 + l_suppkey % 10 AS doc, l_partkey AS n, (l_partkey + l_linenumber) % 11 AS f FROM lineitem"


def _named(i: int) -> str:
    return "CASE f " + " ".join(f"WHEN {k} THEN {case[i]}" for k, case in enumerate(NAMED)) + " END"


@query("printed_names", f"WITH l AS ({NAME_LINES}) SELECT doc, '2019 ONCA ' || n AS raw_string, {_named(1)} AS candidate_case_name, {_named(2)} AS name_rejected_reason FROM l".replace("\n", "' || chr(10) || '"))
def _(v):
    v.t("lineitem").createOrReplaceTempView("lineitem_of_names")
    lines = v.spark.sql(NAME_LINES.replace("FROM lineitem", "FROM lineitem_of_names"))
    cite = F.concat(F.lit("2019 ONCA "), F.col("n").cast("string"))
    text = F.concat(F.expr(_named(0).replace("VARCHAR", "STRING")), cite, F.lit("."))
    docs = lines.select(F.lit("SCC").alias("court"), F.col("doc").alias("corpus_row_index"), cite.alias("citation"), F.lit(2020).alias("year"), text.alias("text"))
    found = extract.extract(docs).where("shape_name = 'shape_neutral_bare'").where(F.col("source_decision_citation") == F.concat(F.lit("SCC_"), fn.nk("raw_string")))
    return classify.case_names(found).select(F.col("corpus_row_index").alias("doc"), "raw_string", "candidate_case_name", "name_rejected_reason")


# --- years that two readings share, labels after citations, the plain route and the filter by year

TEXTS = "SELECT DISTINCT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey * 10 + l_suppkey % 10 AS doc, l_linenumber AS v, l_partkey AS n, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 1990 + l_suppkey % 20 END AS y FROM lineitem"


def _printed_texts(v, text: str) -> DataFrame:
    """One document for each line item, with the text that an expression over doc, v, n and y makes."""
    v.t("lineitem").createOrReplaceTempView("lineitem_of_texts")
    lines = v.spark.sql(TEXTS.replace("FROM lineitem", "FROM lineitem_of_texts"))
    return lines.select(F.lit("SCC").alias("court"), F.col("doc").alias("corpus_row_index"), F.lit("doc").alias("citation"), F.col("y").cast("int").alias("year"), F.expr(text).alias("text"))


@query(
    "misread_years",
    f"""WITH l AS ({TEXTS}), a AS (SELECT doc, v % 2 AS f, CASE v % 2 WHEN 0 THEN 20 ELSE 12 END AS pos, length(CAST(n AS VARCHAR)) + 9 AS size FROM l),
  b AS (SELECT doc, f, 'SCC:' || doc || ':' || pos || ':' || (pos + size) || ':shape_neutral_bare' AS other FROM a)
  SELECT doc, 'shape_bracket' AS shape_name, 'cross_boundary_year_page' AS structural_conflict, other AS conflict_with_candidate FROM b WHERE f = 0
  UNION ALL SELECT doc, 'shape_vol_abbr_page', 'cross_boundary_year_page', other FROM b WHERE f = 0
  UNION ALL SELECT doc, 'shape_year_vol_page', 'year_reread_as_vol', other FROM b WHERE f = 1""",
)
def _(v):
    docs = _printed_texts(v, "CASE WHEN v % 2 = 0 THEN concat('see [1999] ', v, ' S.C.R. 2005 SCC ', n, ' there.') ELSE concat('see (1999), 2005 SCC ', n, ' there.') END")
    return extract.extract(docs).where("structural_conflict <> ''").select(F.col("corpus_row_index").alias("doc"), "shape_name", "structural_conflict", "conflict_with_candidate")


@query("printed_labels", f"WITH l AS ({TEXTS}) SELECT doc, '2019 ONCA ' || n AS raw_string, CASE v % 3 WHEN 0 THEN 'C.A.|Ont.' WHEN 1 THEN 'H.C.' ELSE '' END AS labels, 'shape=shape_neutral_bare|token=ONCA|page=' || n || '|year=2019' AS signature FROM l")
def _(v):
    docs = _printed_texts(v, "concat('see 2019 ONCA ', n, CASE v % 3 WHEN 0 THEN ' (C.A.), (Ont.)' WHEN 1 THEN ' at pp. 4-5 (H.C.) (2d)' ELSE ' (3d) (C.A.)' END, ' there.')")
    found = extract.extract(docs).where("shape_name = 'shape_neutral_bare'")
    sorted_ = F.array_join(F.array_append(F.filter(F.split("parse_signature", r"\|"), lambda x: ~x.startswith("year=") & ~x.startswith("trailing")), F.concat(F.lit("year="), F.col("year_start"))), "|")
    return found.select(F.col("corpus_row_index").alias("doc"), "raw_string", F.array_join(F.transform("suffix_annotations", lambda a: a["raw"]), "|").alias("labels"), sorted_.alias("signature"))


@query("known_years", f"WITH l AS ({TEXTS}) SELECT count(*) AS documents, count(y) AS dated FROM l WHERE y IS NULL OR y >= 2000")
def _(v):
    found = extract.extract(_printed_texts(v, "concat('see 2019 ONCA ', n, ' there.')"), year_from=2000).where("shape_name = 'shape_neutral_bare'")
    return found.agg(F.count(F.lit(1)).alias("documents"), F.count("source_decision_year").alias("dated"))


@query("plain_matches", f"WITH l AS ({TEXTS}) SELECT doc, 'shape_vol_abbr_page' AS shape_name, v || ' O.R. ' || n AS raw_string FROM l UNION ALL SELECT doc, 'shape_neutral_bare', '2019 ONCA ' || n FROM l")
def _(v):
    found = extract.plain_matches(_printed_texts(v, "concat('see ', v, ' O.R. ', n, '; and 2019 ONCA ', n, ' there.')"))
    mine = "(shape_name = 'shape_vol_abbr_page' and raw_string like '% O.R. %') or shape_name = 'shape_neutral_bare'"
    return found.where(mine).select(F.col("corpus_row_index").alias("doc"), "shape_name", "raw_string")

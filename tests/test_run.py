"""Whole runs: the phases of identity, origin and zones meet in one call."""

from pyspark.sql import functions as F

from citeloom.plans import run as plans

CORPUS = [
    # a reporter printed beside a neutral citation, and an appeal: two judgments of one name in near years
    ("SCC", 0, "2020 SCC 901", "[1] Beta v. Gamma, 2015 ONCA 77, [2015] 2 O.R. 400, aff'd Beta v. Gamma, 2016 SCC 44.\n[2] See Beta v. Gamma, 2015 ONCA 77."),
    ("SCC", 1, "2021 SCC 902", "[1] Beta v. Gamma, 2015 ONCA 77, [2015] 2 O.R. 400.\n[2] Delta v. Echo, 2016 SCC 45."),
    ("ONCA", 0, "2019 ONCA 701", "[1] Beta v. Gamma, 2016 SCC 44.\n[2] Delta v. Echo, 2016 SCC 45."),
    # another document's own citation in its header, and a text without any content
    ("ONCA", 1, "2022 ONCA 702", "[1] Delta v. Echo, 2016 SCC 45."),
]
HEAD = "Neutral citation\n{}\nReasons for Judgment\n{}"


def tables(spark):
    docs = [(c, r, own, int(own[:4]), HEAD.format(own, body)) for c, r, own, body in CORPUS]
    docs[3] = (*docs[3][:4], "CITATION: 2001 ONCA 1\nCOURT: X\n" + docs[3][4])
    df = spark.createDataFrame(docs, "court string, corpus_row_index long, citation string, year int, text string")
    courts = spark.createDataFrame([(c, "CA") for c in ("SCC", "ONCA")], "court_code string, jurisdiction string")
    reps = spark.createDataFrame([("O.R.", "CA", "confirmed", None, None, None, None)], "abbreviation string, jurisdiction string, confidence string, vol_from int, vol_to int, year_from int, year_to int")
    return df, courts, reps, spark.createDataFrame([("CA", "CA")], "jurisdiction string, country string")


def test_phases_meet_in_one_run(spark):
    scope = spark.createDataFrame([("onca", "XX", 2010, 2030)], "code string, origin_country string, valid_from int, valid_to int")
    rules = spark.createDataFrame([("or", "O.R.", "YY", "", "exclusive_statute", "verified_exclusive_statute", None, None, 2000, None)], "code string, abbreviation string, origin_country string, origin_subdivision string, exclusivity string, verification_status string, vol_from int, vol_to int, year_from int, year_to int")
    markers = ((r"Reasons for Judgment", "reasons_delivery"),)
    out = plans.run(*tables(spark), evidence=plans.Evidence(scope_rules=scope, reporter_rules=rules, markers=markers))
    # the header of a document names another citation: it is not measured, so it counts for nobody
    status = {r.source_id: r.quarantine_reason for r in out.sources.collect()}
    assert status["ONCA_2022onca702"] == "SOURCE_CITATION_MISMATCH" and set(status.values()) == {"", "SOURCE_CITATION_MISMATCH"}
    assert {r.dd for r in out.groups.where("primary_key = '2016||scc||45'").collect()} == {2}
    # the parallel reporter follows its neutral citation; the appeal stays apart from what it reviewed
    group = {r.merge_key: r.group_id for r in out.members.collect()}
    low, report, high = "2015||onca||77", "2015|2|or||400", "2016||scc||44"
    assert group[low] == group[report] != group[high]
    header = "2001||onca||1"  # printed in the header that is not its document's
    assert group == {low: group[low], report: group[low], high: high, "2016||scc||45": "2016||scc||45", header: header}
    origin = {r.merge_key: (r.member_origin_basis, r.member_origin_country) for r in out.members.collect()}
    assert origin[low] == ("court_scope_rule", "XX") and origin[report] == ("exclusive_reporter_scope", "YY") and origin[high] == ("classification", "CA")
    edges = {(r.source_id, r.group_id): r for r in out.edges.collect()}
    assert {k[0] for k in edges if k[1] == group[low]} == {"SCC_2020scc901", "SCC_2021scc902"}
    assert edges["SCC_2020scc901", group[low]].mention_count == 3
    assert {r.zone_profile for r in edges.values()} == {"reasons_only"}


def test_without_a_history_the_name_joins(spark):
    docs, *rest = tables(spark)
    docs = docs.withColumn("text", F.regexp_replace("text", "aff'd", "and"))
    group = {r.merge_key: r.group_id for r in plans.run(docs, *rest).members.collect()}
    # nothing says that one reviewed the other, but two numbers of neutral citations are never one case
    assert group["2015||onca||77"] != group["2016||scc||44"]

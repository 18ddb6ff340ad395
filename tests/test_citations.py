"""Extraction, arbitration, classification and identity on small texts."""

import itertools
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from citeloom.operators import arbitrate, classify, decide, extract, identity, integrity, merge, quality, scorer
from citeloom.operators import analytics as an
from citeloom.operators.components import connected_components
from citeloom.operators.shapes import ShapeSet

HEAD = "Neutral citation\n{}\nReasons for Judgment\n{}"
# court, row, own citation, body; the six documents of the end-to-end case
CORPUS = [
    ("SCC", 0, "2020 SCC 901", "[1] Meridian v. Horizon, 2019 ONCA 701.\n[2] Again Meridian v. Horizon, 2019 ONCA 701.\n[3] Beacon v. Dune, [1999] 2 S.C.R. 100.\n[4] Footnote 7 Section 69 of the Act. R.S.C. 1985, c. C-46.\n[5] Zenith v. Cedar, 53 Z.Z.R. 88."),
    ("SCC", 1, "2021 CSC 902", "[1] Nous suivons Meridian v. Horizon, 2019 ONCA 701.\n[2] Voir Atlas v. Boreal, 2020 SCC 901."),
    ("ONCA", 0, "2019 ONCA 701", "[1] Atlas v. Boreal, 2020 SCC 901.\n[2] Summit v. Vale, 2018 BCCA 801."),
    ("ONCA", 1, "2022 ONCA 702", "[1] Atlas v. Boreal, 2020 SCC 901."),
    ("BCCA", 0, "2018 BCCA 801", "[1] Atlas v. Boreal, 2020 SCC 901."),
    ("BCCA", 1, "2023 BCCA 802", "[1] Meridian v. Horizon, 2019 ONCA 701.\n[2] Footnote 7 Section 69 of the Act."),
]


@pytest.fixture(scope="module")
def ledger(spark):
    docs = spark.createDataFrame([(c, r, own, int(own[:4]), HEAD.format(own, body)) for c, r, own, body in CORPUS], "court string, corpus_row_index long, citation string, year int, text string")
    cand = extract.extract(docs, ShapeSet())
    courts = spark.createDataFrame([(c, "CA") for c in ("SCC", "CSC", "ONCA", "BCCA")], "court_code string, jurisdiction string")
    reps = spark.createDataFrame([("S.C.R.", "CA", "confirmed", None, None, 1923, None)], "abbreviation string, jurisdiction string, confidence string, vol_from int, vol_to int, year_from int, year_to int")
    c = classify.classify(cand, courts, reps, words={"first_word": ["section"], "whole": ["section"]})
    from citeloom.functions import scalar as fn

    slot = fn.series_component("series_paren", "series", "paren_note", "shape_name")
    c = c.withColumn("merge_key", fn.merge_key_v2("year_start", "vol", "abbreviation", slot, "page", "page_roman", "series_prefix"))
    c = c.withColumn("grade", arbitrate.support_grade(F.col("rejected_reason"), F.col("parse_status"), F.col("citation_kind"), F.col("lookup_mode"), F.col("jurisdiction")))
    return arbitrate.arbitrate(c, ["court", "corpus_row_index"]).cache()


def test_six_documents(ledger):
    rows = ledger.where("arbitration_status = 'counted'").select("merge_key", "source_decision_citation").distinct().collect()
    got = {}
    for r in rows:
        got.setdefault(r.merge_key, set()).add(r.source_decision_citation)
    assert got == {
        "2020||scc||901": {"SCC_2021csc902", "ONCA_2019onca701", "ONCA_2022onca702", "BCCA_2018bcca801"},
        "2019||onca||701": {"SCC_2020scc901", "SCC_2021csc902", "BCCA_2023bcca802"},
        "2018||bcca||801": {"ONCA_2019onca701"}, "1999|2|scr||100": {"SCC_2020scc901"}, "|53|zzr||88": {"SCC_2020scc901"},
    }
    assert ledger.where("arbitration_status = 'self_citation_row' and citation_kind = 'neutral'").count() == 6
    n = ledger.groupBy("candidate_id").count()
    assert n.where("count > 1").count() == 0
    names = {r.merge_key: r.candidate_case_name for r in ledger.where("arbitration_status = 'counted' and merge_key = '1999|2|scr||100'").collect()}
    assert names == {"1999|2|scr||100": "Beacon v. Dune"}


def test_spans_point_at_the_text(ledger, spark):
    text = {(c, r): HEAD.format(own, body) for c, r, own, body in CORPUS}
    for r in ledger.collect():
        t = text[r.court, r.corpus_row_index]
        assert " ".join(t[r.match_start_offset : r.match_end_offset].split()) == r.raw_string
        if r.page_span:
            assert t[r.page_span.start : r.page_span.end] in (r.page, r.page_roman)


def shapes_of(text, **kw):
    return {(c["shape_name"], c["raw_string"]) for c in extract.candidates(text, "X", 0, None, None, ShapeSet(**kw))}


def test_shapes():
    t = "47 D.L.R. (2d) 400 (1964), (1924) A.C. 222. 70 O.R. 2(d) 717; [1938-39] C.T.C. 138; (1866) L.R. 2 Ch. App. 127; 2005TCC640; A-675-94 and 12 U.C.Q.B. (H.L.) 3 (1850)"
    got = shapes_of(t, codes=["TCC"], id_rows=[{"prefix_regex": "A", "body_regex": r"-\d{1,5}-\d{2}", "canonical_token": "{prefix}-"}])
    for want in [
        ("shape_vol_page_year", "47 D.L.R. (2d) 400 (1964)"), ("shape_paren_year_abbr_page", "(1924) A.C. 222"), ("shape_vol_abbr_page_transposed_series", "70 O.R. 2(d) 717"), ("shape_bracket_range", "[1938-39] C.T.C. 138"),
        ("shape_leading_abbr", "(1866) L.R. 2 Ch. App. 127"), ("shape_neutral_glued", "2005TCC640"), ("shape_registered_id", "A-675-94"), ("shape_nominate", "12 U.C.Q.B. (H.L.) 3 (1850)"),
    ]:
        assert want in got
    one = [c for c in extract.candidates("A-675-94", "X", 0, None, None, ShapeSet(id_rows=[{"prefix_regex": "A", "body_regex": r"-\d{1,5}-\d{2}", "canonical_token": "{prefix}-"}])) if c["shape_name"] == "shape_registered_id"]
    assert (one[0]["token"], one[0]["page"]) == ("A-", "675-94")
    comp = shapes_of("[1990] I.L.R. 1-2261", locator_rows=[{"abbreviation_regex": r"I\.\s*L\.\s*R\.", "locator_regex": r"1-\d{3,5}"}])
    assert ("shape_bracket_compound_locator", "[1990] I.L.R. 1-2261") in comp


def test_overlapping_scan_and_fallback():
    form = next(f for f in ShapeSet().forms if f.name == "shape_vol_abbr_page")
    kept, refused = form.overlapping("123 A.C. 4")
    assert [(h.start, h.end) for h in kept] == [(0, 10)] and refused == 2
    assert extract.fallback_ok("SCC", "1", "1999") and extract.fallback_ok("A.C.", "1", "1999") and not extract.fallback_ok("Sup. Ct. Rev.", "1", "1999") and not extract.fallback_ok("S.M.", "1978", "1978")
    flags = {c["raw_string"]: c["structural_conflict"] for c in extract.candidates("2001 SCC 2005 TCC 640", "X", 0, None, None, ShapeSet()) if c["shape_name"] == "shape_neutral_bare"}
    assert flags["2001 SCC 2005"] == "cross_boundary_year_page"
    assert len(extract.capture_suffix("x (H.L.), (CanLII) (2d) (P.C.)", 1)) == 2
    for text, want in {"x at para. 3-5 (a (b) c)": ["a (b) c"], "x (a (b (c)))": [], "x ()": [], "x (a)(b)(c)(d)": ["a", "b", "c"], "x (a()b)": [], "x (open": [], "x" + " " * 238 + "(a)": [], f"x ({'a' * 81})": [], f"x ({'a' * 80})": ["a" * 80]}.items():
        assert [s["raw"] for s in extract.capture_suffix(text, 1)] == want


def test_greedy_dedup_matches_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.randint(0, 3), s := rng.randint(0, 60), s + rng.randint(1, 15), rng.randint(0, 3)) for _ in range(120)]
    df = spark.createDataFrame(sorted(set(rows)), "doc long, start long, end long, rank long")
    got = {(r.doc, r.start, r.end, r.rank): r.superseded_by for r in extract.greedy_dedup(df).collect()}
    for d in {r[0] for r in got}:
        kept = []
        for r in sorted((r for r in got if r[0] == d), key=lambda r: (r[1] - r[2], r[1], r[3])):
            hit = next((k for k in kept if r[1] < k[2] and k[1] < r[2]), None)
            assert got[r] == (None if hit is None else f"{hit[1]}:{hit[2]}:{hit[3]}")
            if hit is None:
                kept.append(r)


def test_greedy_dedup_takes_islands_not_documents(spark):
    rows = [("a", 0, 10, 1), ("a", 2, 12, 0), ("a", 11, 13, 0), ("a", 13, 13, 0), ("a", 20, None, 0), ("a", 30, 40, 2), ("a", 30, 40, 1), ("a", 30, 40, 1), (None, 0, 4, 0), (None, 3, 5, 0), ("b", 1, 3, None)]
    out = extract.greedy_dedup(spark.createDataFrame(rows, "doc string, start long, end long, rank long"))
    got = sorted(tuple(str(x) for x in r) for r in out.collect())
    want = {("a", 2, 12, 0): "0:10:1", ("a", 30, 40, 2): "30:40:1", (None, 3, 5, 0): "0:4:0"}
    assert got == sorted(tuple(str(x) for x in (*r, want.get(r))) for r in rows)
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()  # a call for each document


def reading(i, a, b, key, grade=2, **kw):
    return {"candidate_id": i, "match_start_offset": a, "match_end_offset": b, "merge_key": key, "grade": grade, "shape_name": "shape_bracket", "rejected_reason": "", "self_citation": False} | kw


def test_arbitration_rules():
    rows = [reading("a", 0, 20, "k1", vol="1"), reading("b", 4, 20, "k2"), reading("c", 30, 50, "k3", 1), reading("d", 45, 60, "k4", 2), reading("e", 70, 80, "k5", 1), reading("f", 70, 80, "k6", 1), reading("g", 90, 99, "k7", rejected_reason="x")]
    want = {"a": "counted", "b": "alternative_contained", "c": "alternative_dominated_by_support", "d": "counted", "e": "span_alternative_undecided", "f": "span_alternative_undecided", "g": "rejected_row"}
    for p in itertools.islice(itertools.permutations(rows), 0, 5040, 331):
        assert {k: v[0] for k, v in arbitrate.arbitrate_document(list(p)).items()} == want
    wide = [reading("l", 0, 40, "k", 1, page="9"), reading("s", 2, 10, "k1", 2), reading("t", 20, 30, "k2", 2)]
    assert {k: v[0] for k, v in arbitrate.arbitrate_document(wide).items()} == {"l": "alternative_spanning_mismatch", "s": "counted", "t": "counted"}


def test_case_names():
    cases = {
        "x\nMeridian v. Horizon, ": ("Meridian v. Horizon", ""), "the court said: see also Beacon v. Dune, ": ("Beacon v. Dune", ""), "x\nRe Smith, ": ("Re Smith", ""), "no name here": ("", "no_v_structure"),
        "no separator Beacon v. Dune ": ("", "no_separator_before_v"), "a: X v. Y; Then other, ": ("", "name_belongs_to_later_segment"), "cases: Rizzo v. Shoes, [1998] 1 S.C.R. 27; Bell v. Bell, ": ("Bell v. Bell", ""),
        "voir: citant Renvoi sur la sécession, ": ("Renvoi sur la sécession", ""), None: ("", "no_v_structure"),
    }
    for pre, want in cases.items():
        assert classify.cut_name(pre) == want


def test_zones(spark):
    df = spark.createDataFrame([(1, "head APPEAL x END y REASONS body"), (2, "nothing"), (3, None)], "doc long, text string")
    got = {r.doc: r for r in integrity.locate_zones(df, [("REASONS", "reasons_delivery"), ("APPEAL", "appeal_start"), ("END", "appeal_end")]).collect()}
    assert got[1].reasons_start == 20 and [tuple(s) for s in got[1].appeal_spans] == [(5, 14)] and got[2].status == got[3].status == "no_verified_boundary"


def test_integrity(spark):
    text = "CITATION: 2020 SCC 5\nDATE: 20200105\nJUDGES: X\n[1] Body\nDATE: 20210101"
    df = spark.createDataFrame([(text, "2020 SCC 5", None), (text, "2020 SCC 6", None), ("plain", "2020 SCC 5", None), ("Smith\nThe Honourable Justice Jones", "c", "Smith")], "t string, c string, n string")
    got = df.select(integrity.own_citation(F.col("t"), F.col("c")).alias("own"), integrity.native_date(F.col("t"), F.lit(None).cast("date")).alias("d"), integrity.text_integrity(F.col("t"), F.col("n"), F.col("c")).alias("i")).collect()
    assert [r.own for r in got] == ["MATCH", "MISMATCH", "NO_VERIFIED_CITATION", "NO_VERIFIED_CITATION"]
    assert str(got[0].d.date) == "2020-01-05" and got[0].d.basis == "native" and got[2].d.status == "NO_FORMAL_DATE"
    assert [r.i for r in got] == ["PRESENT_UNVERIFIED"] * 3 + ["INCOMPLETE_HEADER_SIGNATURE"]


def test_components_against_union_find(spark):
    import random

    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 5001 + i) for i in range(300)] + [(9, 9)]
    of = {}

    def find(a):
        of.setdefault(a, a)
        while of[a] != a:
            a = of[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        of[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {a: find(a) for a in of}


def test_identity(spark):
    rows = [("a", "1999||scc||1", "x", 1999, "neutral"), ("b", "|1|scr||5", "x", 2000, "reporter"), ("c", "|2|scr||6", "x", 2003, "reporter"), ("d", "1999||scc||2", "x", 1999, "neutral"), ("e", "|9|q||1", "y", 1999, "reporter")]
    df = spark.createDataFrame(rows, "row_key string, merge_key string, name string, year int, kind string")
    links = spark.createDataFrame([("a", "b", "name_year"), ("b", "c", "name_year"), ("a", "d", "name_year")], "a string, b string, rule string")
    groups, trace = identity.solve(df, links)
    assert {r.row_key: r.group_id for r in groups.collect()} == {"a": "a", "b": "a", "c": "c", "d": "d", "e": "e"}
    assert sorted(r.outcome for r in trace.collect()) == ["accepted", "different_neutral_numbers", "year_span"]
    assert {r.row_key: r.identity_basis for r in identity.identity_basis(groups, trace).collect()} == {"a": "anchor", "b": "name_year", "c": "singleton", "d": "singleton", "e": "singleton"}
    assert identity.windows_of([1990, 1991, 1992, 1995]) == [0, 0, 1, 2]


def test_numbers_in_order(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = [(r.k, r.n) for r in decide.ordered_number(df, "k", "n").collect()]
    assert sorted(got) == [(k, i + 1) for i, k in enumerate(sorted(k for k, _ in got))]


def test_questions():
    assert an.route_question("top 10 most cited cases in ONCA", ["ONCA"]) == ("ranking", an.Filters(court="ONCA"), 10)
    assert an.route_question("how many citations from 1990 to 1999?", [])[1] == an.Filters(year_from=1990, year_to=1999)
    for bad in ("drop table edges", "what is love", "top 10 most cited cases of the moon"):
        with pytest.raises(ValueError, match="unsupported"):
            an.route_question(bad, ["ONCA"])
    assert an.offline_answer("count", None) == "No result."


def test_quality(spark):
    assert quality.court_order(["a", "c"], ["b", "c"]) == ["a", "b", "c"]
    with pytest.raises(ValueError):
        quality.court_order(["a", "b"], ["b", "a"])
    o = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "z"), (5, "z"), (6, "w")], "member long, group_id string")
    n = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r"), (4, "s"), (5, "s"), (7, "t")], "member long, group_id string")
    assert sorted(r.change for r in quality.match_groups(o, n).collect()) == ["new_only", "old_only", "one_to_one_same", "one_to_one_same", "split"]


def test_gates(spark):
    df = spark.createDataFrame([("y", 0.85, 4.0), ("y", 0.7, 9.0), ("none", 0.99, 9.0), (None, None, None), ("y", 0.1, 1.0)], "c string, p double, r double")
    got = [tuple(x.g) for x in df.select(scorer.gate("T1", F.col("c"), F.col("p"), F.col("r"), abstain=("none",)).alias("g")).collect()]
    assert got == [("adopt", ""), ("review", "below_T1"), ("reject", "abstained"), ("reject", "no_answer"), ("reject", "low_probability")]


def test_merge_runs(spark):
    df = spark.createDataFrame([("d", i, k, g) for i, (k, g) in enumerate([("a", False), ("b", True), ("a", False), ("a", True), ("c", False)])], "doc string, i int, merge_key string, joined boolean")
    got = [(r.merge_key, r.run) for r in merge.islands(df, "doc", ["i"], F.col("joined")).orderBy("i").collect()]
    assert got == [("a", 1), ("b", 1)]


def documents_of(spark, folder, texts):
    """A folder of tables: documents with these texts, and labels of the first only."""
    rows = [(i, t) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_every_document_is_extracted(spark, tmp_path):
    import __spark_entry__ as entry

    prose = "x " * 4000
    texts = ["see 2018 BCCA 801, here", f"{prose}[1999] 2 S.C.R. 100 {prose}2019 ONCA 701", "", None, "no citation; 123 A.C. 4"]
    got = {(int(r.candidate_id.split(":")[1]), r.shape_name, r.match_start_offset, r.match_end_offset) for r in entry.queries()["shape_extraction"](spark, documents_of(spark, tmp_path, texts)).collect()}
    want = set()
    for i, t in enumerate(texts, 1):
        if t is None:
            continue
        t += f"\nMeridian v. Horizon, 2019 ONCA {i}. Beacon v. Dune, [1999] 2 S.C.R. {i} (S.C.C.); 47 D.L.R. (2d) {i}."
        for name, rx in ((f.name, f.rows[0][0]) for f in ShapeSet().forms):
            seen = set()
            for at in range(len(t)):
                m = rx.match(t, at)
                run = at
                while run and t[run - 1].isalnum():
                    run -= 1
                if m and (run == at or not any(run <= x < at for x in seen)):
                    seen.add(at)
                    want.add((i, name, at, m.end()))
    assert {i for i, *_ in got} == {1, 2, 3, 5}
    assert {g for g in got if g[1] != extract.FALLBACK} == {w for w in want if w[1] != extract.FALLBACK}


def test_case_names_of_whole_documents(spark, tmp_path):
    import __spark_entry__ as entry

    prose = "long prose without any names in it " * 300
    texts = [f"{prose}\nWe follow Rizzo v. Shoes, [1998] 1 S.C.R. 27; Bell v. Bell, 2001 SCC 5. {prose}", f"{prose}: citant Renvoi sur la sécession, [1998] 2 R.C.S. 217 {prose}", f"{prose}: X v. Y; Then other, 2003 SCC 7"]
    rows = entry.queries()["case_names"](spark, documents_of(spark, tmp_path, texts)).collect()
    got = {(r.doc_id, r.raw_string): (r.candidate_case_name, r.name_rejected_reason) for r in rows}
    assert got[1, "[1998] 1 S.C.R. 27"] == ("Rizzo v. Shoes", "") and got[1, "2001 SCC 5"] == ("Bell v. Bell", "")
    assert got[2, "[1998] 2 R.C.S. 217"] == ("Renvoi sur la sécession", "")
    assert got[3, "2003 SCC 7"] == ("", "name_belongs_to_later_segment")
    for i in (1, 2, 3):
        assert got[i, f"2019 ONCA {i}"] == ("Meridian v. Horizon", "")


def test_opposite_history_sides_stay_apart(spark):
    rows = [("a", [("i1", "before")]), ("b", [("i1", "after")]), ("c", [("i1", "before"), ("i2", "after")]), ("d", None)]
    df = spark.createDataFrame(rows, f"row_key string, history_sides {identity.SIDES}")
    links = spark.createDataFrame([("a", "b", "name_year"), ("a", "c", "name_year"), ("b", "d", "name_year")], "a string, b string, rule string")
    groups, trace = identity.solve(df, links)
    assert {r.row_key: r.group_id for r in groups.collect()} == {"a": "a", "b": "b", "c": "a", "d": "b"}
    assert sorted(r.outcome for r in trace.collect()) == ["accepted", "accepted", "opposite_history_sides"]


def test_settled_readings_are_the_least_fixed_point():
    """``settle`` against rounds over all readings until nothing changes."""
    import random

    rng = random.Random(17)
    for _ in range(300):
        n = rng.randint(1, 9)
        rs = [arbitrate.Reading(i, i + 1, str(i), [reading(str(i), i, i + 1, str(i))]) for i in range(n)]
        for r in rs:
            r.attackers = [("contained", x) for x in rs if x is not r and rng.random() < 0.25]
            r.parts = rng.sample([x for x in rs if x is not r], min(n - 1, rng.choice([0, 0, 2, 3])))
            r.struck = ("x", "") if rng.random() < 0.1 else None
        state = {r: False if r.struck else None for r in rs}
        while True:
            new = dict(state)
            for r in rs:
                foes, parts = [state[x] for _, x in r.attackers], [state[x] for x in r.parts]
                if state[r] is None and (True in foes or parts.count(True) >= 2):
                    new[r] = False
                elif state[r] is None and None not in foes + parts:
                    new[r] = True
            if new == state:
                break
            state = new
        arbitrate.settle(rs)
        assert [r.stands for r in rs] == [state[r] for r in rs]


def test_arbitration_of_repeated_rows_and_ids(spark):
    rows = [("d1", "a", 0, 20, "k1"), ("d1", "a", 0, 20, "k1"), ("d1", "b", 4, 18, "k1"), ("d2", "a", 0, 5, "k9"), (None, "a", 0, 5, "k9")]
    df = spark.createDataFrame(rows, "doc string, candidate_id string, match_start_offset int, match_end_offset int, merge_key string").withColumns({"shape_name": F.lit("shape_bracket"), "grade": F.lit(1)})
    got = sorted((str(r.doc), r.candidate_id, r.arbitration_status, r.superseded_by_candidate) for r in arbitrate.arbitrate(df, ["doc"]).collect())
    assert got == [("None", "a", "counted", ""), ("d1", "a", "counted", ""), ("d1", "a", "counted", ""), ("d1", "b", "alternative_same_key", "a"), ("d2", "a", "counted", "")]


def test_transposed_series_completes_only_with_proof():
    text = "70 O.R. 2(d) 717"
    short = reading("s", 0, 9, "k1", 1, shape_name="shape_vol_abbr_page", raw_string=text[:9], vol="70", abbr="O.R.", page="2", citation_kind="reporter")
    long_ = reading("l", 0, 16, "k2", 1, shape_name="shape_vol_abbr_page_transposed_series", raw_string=text, vol="70", abbr="O.R.", page="717", series="2d", citation_kind="reporter", lookup_mode="exact", vol_span={"start": 0, "end": 2})
    assert arbitrate.completes(short, long_)
    for change in ({"citation_kind": "neutral"}, {"lookup_mode": ""}, {"series": "4d"}, {"year_start": "1999"}, {"vol": "71"}, {"grade": 0}, {"raw_string": "70 O.R. 2(d) 718"}):
        assert not arbitrate.completes(short | ({"year_start": "1998"} if "year_start" in change else {}), long_ | change)


def test_islands_settle_as_the_whole_document(spark):
    import random

    rng = random.Random(4)
    rows = []
    for d in range(40):
        for i in range(rng.randint(1, 14)):
            a = rng.randrange(80)
            mark = rng.choice(["cross_boundary_year_page", "year_reread_as_vol"]) if d % 8 == 0 and rng.random() < 0.3 else None
            rows.append((f"d{d}", f"c{i}", a, a + rng.randint(1, 12), f"k{rng.randrange(3)}", rng.randrange(3), rng.random() < 0.1, mark, f"c{rng.randrange(10)}" if mark else None))
    names = "doc candidate_id match_start_offset match_end_offset merge_key grade self_citation structural_conflict conflict_with_candidate".split()
    df = spark.createDataFrame(rows, "doc string, candidate_id string, match_start_offset int, match_end_offset int, merge_key string, grade int, self_citation boolean, structural_conflict string, conflict_with_candidate string").withColumns({"shape_name": F.lit("shape_bracket"), "_island": F.lit("mine")})
    got = {(r.doc, r.candidate_id): (r.arbitration_status, r.superseded_by_candidate) for r in arbitrate.arbitrate(df, ["doc"]).collect()}
    for d in range(40):
        mine = [dict(zip(names, r, strict=True)) | {"shape_name": "shape_bracket"} for r in rows if r[0] == f"d{d}"]
        for name, told in arbitrate.arbitrate_document(mine).items():
            assert got[f"d{d}", name] == told
    assert arbitrate.arbitrate(df.limit(0), ["doc"]).count() == 0


def test_labels_spread_to_their_fixed_point(spark):
    from citeloom.operators import quality

    pairs = [(i, i + 1) for i in range(15)] + [(20, 21), (21, 22), (3, None)]
    known = [(0, "x"), (20, "y"), (22, "z"), (None, "q")]
    got = sorted(map(tuple, quality.propagate_labels(spark.createDataFrame(known, "item int, label string"), spark.createDataFrame(pairs, "a int, b int")).collect()))
    assert got == [(i, "x", i) for i in range(16)] + [(20, "y", 0), (22, "z", 0)]


def test_lookups_leave_candidates_where_they_are(spark):
    """Few abbreviations make up most candidates: a shuffle by them would be a few tasks."""
    rows = spark.createDataFrame([(7, "SCC", "2020 SCC 7", 2020, "see 2019 ONCA 12, 53 Z.Z.R. 9 there.")], "corpus_row_index long, court string, citation string, year int, text string")
    courts = spark.createDataFrame([("ONCA", "CA")], "court_code string, jurisdiction string")
    reporters = spark.createDataFrame([("U.S.", "US", "confirmed", None, None, None, None)], "abbreviation string, jurisdiction string, confidence string, vol_from int, vol_to int, year_from int, year_to int")
    found = extract.extract(rows)
    plan = classify.classify(found, courts, reporters)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan
    # each island is settled once: nothing filters the packed islands by what was settled
    c = classify.classify(found, courts, reporters).withColumn("merge_key", F.col("raw_string")).withColumn("grade", F.lit(1))
    plan = arbitrate.arbitrate(c, ["court", "corpus_row_index"], ("raw_string",)).where("arbitration_status = 'counted'")
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("verdicts(") == 1
    assert {r.raw_string for r in plan.collect()} == {"2019 ONCA 12", "53 Z.Z.R. 9"}


def test_same_row_number_of_two_courts_is_two_documents(spark):
    rows = spark.createDataFrame([("A", 1, "see (1990) S.C.R. 12."), ("B", 1, "see 12 O.R. 1990 xx")], "court string, corpus_row_index long, text string").coalesce(1)
    assert {(r.court, r.shape_name) for r in extract.plain_matches(rows).collect()} == {("A", "shape_paren_year_abbr_page"), ("B", "shape_vol_abbr_page")}


def test_printed_forms_of_large_part_numbers(spark, tmp_path):
    """Locators of six digits, and line items whose numbers come to one document number."""
    import __spark_entry__ as entry

    rows = [(1, 1, 120000 + i, 3) for i in range(11)] + [(1, 2, 20000 + i, 3) for i in range(11)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = [tuple(map(str, r)) for r in entry.queries()["printed_forms"](spark, str(tmp_path)).collect()]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert sorted(got) == sorted(tuple(map(str, r)) for r in duck.execute(entry.oracle_sql()["printed_forms"]).fetchall())


def test_printed_forms_of_part_numbers_of_seven_digits(spark, tmp_path):
    import __spark_entry__ as entry

    rows = [(1, 1, 1200000 + i, 3) for i in range(11)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = [tuple(map(str, r)) for r in entry.queries()["printed_forms"](spark, str(tmp_path)).collect()]
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert sorted(got) == sorted(tuple(map(str, r)) for r in duck.execute(entry.oracle_sql()["printed_forms"]).fetchall())
    assert [f.overlapping("2005TCC1234567")[0] for f in ShapeSet(codes=["TCC"]).forms if f.name == "shape_neutral_glued"] == [[]]  # six digits where nothing else is said


def test_language_of_absent_and_blank_fields(spark, tmp_path):
    """Rows whose text, language or source is absent or blank."""
    import __spark_entry__ as entry

    told = [None, "", " ", "\u00a0", "fr", "en"]
    rows = [(i, text, lang, source) for i, (text, lang, source) in enumerate((t, x, s) for t in (*told, ".", "-x") for x in told for s in (*told, "-"))]
    rows += [(i + 1001, *r[1:]) for i, r in enumerate(rows)] + [(None, "a", "fr", "s"), (None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = entry.queries()["scan_project_language"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(entry.oracle_sql()["scan_project_language"])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_pairs_settle_as_documents_do():
    """Two candidates alone are settled as beside a third one far away, which takes the general way."""
    import random

    rng = random.Random(11)
    far = {"candidate_id": "z", "shape_name": "shape_bracket", "match_start_offset": 90, "match_end_offset": 95, "merge_key": "z", "grade": 1}
    seen = set()
    for _ in range(20_000):
        two = [
            {"candidate_id": f"c{i}", "shape_name": rng.choice(["shape_bracket", "shape_vol_abbr_page", "shape_vol_abbr_page_transposed_series"]), "match_start_offset": (a := rng.randint(0, 4)), "match_end_offset": a + rng.randint(0, 4), "merge_key": rng.choice("ab"), "grade": rng.randint(0, 2)}
            | {"rejected_reason": rng.choice(["", "", None, "x"]), "self_citation": rng.choice([None, False, False, True]), "page": rng.choice(["", "2", "3"]), "abbr": rng.choice(["", "O.R.", "or"])}
            for i in range(2)
        ]
        got = arbitrate.arbitrate_document(two)
        assert got | {"z": ("counted", "")} == arbitrate.arbitrate_document([*two, far])
        seen |= {state for state, _ in got.values()}
    assert len(seen) > 7


def test_documents_longer_than_a_batch_settle_as_whole(spark):
    """Documents that go over the edges of Arrow batches, with equal places and marks, as each alone."""
    import random

    rng = random.Random(12)
    rows = [(f"d{d}" if d else None, f"{d}:{i}", "shape_bracket", a, a + rng.randint(1, 3), rng.choice("abc"), rng.randint(0, 2), rng.choice(["", "x", None]) if i % 9 == 0 else "", f"{d}:{rng.randrange(40)}" if d == 3 and i % 7 == 0 else "") for d in range(6) for i in range(40) for a in [rng.randint(0, 60)]]
    names = "doc candidate_id shape_name match_start_offset match_end_offset merge_key grade rejected_reason conflict_with_candidate".split()
    df = spark.createDataFrame(rows, "doc string, candidate_id string, shape_name string, match_start_offset int, match_end_offset int, merge_key string, grade int, rejected_reason string, conflict_with_candidate string")
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = {r.candidate_id: (r.arbitration_status, r.superseded_by_candidate) for r in arbitrate.arbitrate(df, ["doc"], ("candidate_id",)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    want = {}
    for d in {r[0] for r in rows}:
        want |= arbitrate.arbitrate_document([dict(zip(names, r, strict=True)) for r in rows if r[0] == d])
    assert got == want


def test_only_read_columns_are_extracted(spark):
    docs = spark.createDataFrame([("SCC", 1, "2020 SCC 1", 2020, "see [1999] 2 S.C.R. 2005 SCC 7 (C.A.) there."), ("SCC", 2, "2020 SCC 2", 2020, "see [1999] 2 S.C.R. 2005 SCC 7 (C.A.) there.")], "court string, corpus_row_index long, citation string, year int, text string")
    every = extract.extract(docs)
    some = ("candidate_id", "conflict_with_candidate", "conflict_note", "vol_span")
    few = extract.extract(docs, columns=some)
    assert set(few.columns) == set(some)
    assert sorted(map(str, few.collect())) == sorted(map(str, every.select(few.columns).collect()))
    marked = [r for r in few.collect() if r.conflict_with_candidate]
    assert marked and all(r.conflict_with_candidate.split(":")[:2] == r.candidate_id.split(":")[:2] for r in marked)  # copies name candidates of their own document


def test_coverage_equals_plain_counts(spark):
    import random

    rng = random.Random(6)
    rows = [(rng.choice(["s", "t", "u", None]), rng.choice([1, 2, None]), rng.choice(["A", "R", None]), rng.choice(["x", "y", None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "source_id string, position int, flag string, kind string")
    want = Counter()
    for level, mine in ((0, lambda r: (r[2], r[3])), (1, lambda r: (r[2], None)), (3, lambda r: (None, None))):
        for k in {mine(r) for r in rows}:
            at = [r for r in rows if mine(r) == k]
            want[*k, len(at), len({r[:2] for r in at}), len({r[0] for r in at} - {None}), level] += 1
    out = an.coverage(df, ["flag", "kind"], ["source_id", "position"])
    assert Counter(map(tuple, out.collect())) == want and an.coverage(df.limit(0), ["flag", "kind"], ["source_id", "position"]).isEmpty()
    assert "Expand" not in out._jdf.queryExecution().toString()  # rows are not multiplied before an exchange


def test_copies_of_a_text_are_read_once(spark, tmp_path):
    """A form that notes each text it searches: of 200 copies every task reads one."""
    from citeloom.operators import extract
    from citeloom.operators.shapes import ShapeSet

    class Noting(ShapeSet):
        def __init__(self, at):
            super().__init__()
            self.at, form = at, self.forms[0]
            object.__setattr__(form, "needs", type("Seen", (), {"search": staticmethod(lambda text, at=at: open(f"{at}/{len(text)}-{__import__('uuid').uuid4().hex}", "w").close())}))

        def __reduce__(self):
            return Noting, (self.at,)

    texts = ["see 2019 ONCA 7, there.", "see (1999), 2005 SCC 12 there."]
    docs = spark.createDataFrame([("SCC", i, f"d{i}", 1990 + i % 3, texts[i // 200]) for i in range(210)], "court string, corpus_row_index long, citation string, year int, text string")
    seen = extract.extract(docs, Noting(str(tmp_path))).collect()
    assert sum(f.name.startswith(f"{len(texts[0])}-") for f in tmp_path.iterdir()) <= extract.COPY_TASKS
    shapes = ShapeSet()
    want = [c["candidate_id"] + "|" + str(c["source_decision_year"]) + c["source_decision_citation"] + c["conflict_note"] + c["conflict_with_candidate"] for i in range(210) for c in extract.candidates(texts[i // 200], "SCC", i, f"SCC_d{i}", 1990 + i % 3, shapes)]
    assert sorted(r.candidate_id + "|" + str(r.source_decision_year) + r.source_decision_citation + r.conflict_note + r.conflict_with_candidate for r in seen) == sorted(want)

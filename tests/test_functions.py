from pyspark.sql import functions as F

from citeloom.functions import scalar as fn


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def cases():
    return [
    (fn.nk(F.lit("S.C.R. K9")), "scr9"), (fn.normalize_code(F.lit("on-ca .x")), "ONCAX"), (fn.unpad(F.lit("scc00901")), "scc901"), (fn.collapse_space(F.lit(" a  b\n")), "a b"),
    (fn.month_name(F.lit("March,")), "march"), (fn.month_name(F.lit("Mar")), None), (fn.date_form_hit(F.lit("May"), F.lit("12"), F.lit("1990")), True), (fn.date_form_hit(F.lit("May"), F.lit("32"), F.lit("1990")), False),
    (fn.abbreviated_date_form_hit(F.lit("Sept"), F.lit("1"), F.lit("1990")), True), (fn.abbreviated_date_form_hit(F.lit("Ma"), F.lit("1"), F.lit("1990")), False),
    (fn.reasons(("a", F.lit(True)), ("b", F.lit(False)), ("c", F.lit(True))), "a|c"), (fn.canon_series(F.lit("(4TH)")), "4d"), (fn.canon_series(F.lit("3d")), "3d"),
    (fn.series_component(F.lit(None), F.lit(None), F.lit("N.S."), F.lit("shape_bracket")), "n:ns"), (fn.series_component(F.lit(None), F.lit(None), F.lit("Ont. C.A."), F.lit("shape_nominate")), ""),
    (fn.merge_key_v1(F.lit("1999"), F.lit("2"), F.lit("S.C.R."), F.lit(None), F.lit("100")), "1999|2|scr||100"), (fn.merge_key_v2(F.lit(""), F.lit("6"), F.lit("Q.B."), F.lit(""), F.lit(""), F.lit("XI"), F.lit("L.R.")), "|6|lr.qb||ro:xi"),
    (fn.family_key(F.lit("1999|2|scr||100")), "|2|scr||100"), (fn.row_year(F.lit(""), F.lit("1999|2|scr||100")), 1999), (fn.title_key(F.lit("Smith v. Jones (1999)")), "smithvjones"),
    (fn.year_of(F.lit("1999 SCC")), 1999), (fn.source_year(F.lit("SCC_2020scc901")), 2020), (fn.dd_band(F.lit(20)), "20-99"), (fn.era(F.lit(1982)), "1982-1999"), (fn.decade(F.lit(1999)), 1990),
    (fn.contains_literal(F.lit("50% of"), "0%"), True), (fn.passage(F.lit("abc  def"), F.lit(3), F.lit(5), 1, 1), "c d"), (fn.gap_text(F.lit(5), F.lit(8), F.lit("xx, y")), ", y"), (fn.gap_text(F.lit(5), F.lit(20), F.lit("xx")), None),
    (fn.parallel_gap(F.lit(" , ")), True), (fn.parallel_gap(F.lit("; ")), False), (fn.parallel_gap(F.lit(" (H.L.), "), F.array(F.lit("H.L."))), True), (fn.one_edit(F.lit("12"), F.lit("21")), False),
    (fn.casefold(F.lit("Straße")), "strasse"), (fn.case_context_tokens(F.lit("Évans v. The Crown Ltd.")), ["crown", "evans"]), (fn.case_context_tokens(F.lit("Crown matter")), []),
    (fn.history_eligible(F.lit("A"), F.lit("B"), F.lit(1999), F.lit(1998), F.lit(True)), True), (fn.history_eligible(F.lit("A"), F.lit("A"), F.lit(1997), F.lit(1998), F.lit(True)), False),
]


def test_scalar(spark):
    wanted = cases()
    got = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(wanted)]).first()
    assert list(got) == [w for _, w in wanted]


def test_dates(spark):
    got = one(spark, fn.header_dates(F.lit("DATE: 2001-02-03\nHeard: March 4, 1999; 2001-02-03; 2001-02-31")))
    assert [str(d) for d in got] == ["2001-02-03", "1999-03-04"]
    assert one(spark, fn.valid_date(F.lit("1999-02-29T00"))) is None
    assert one(spark, fn.parse_name_classes(F.lit("a:4|b:2"))) == {"a": 4, "b": 2}
    assert one(spark, fn.fact_id(b=F.lit(1), a=F.lit("x"))) == one(spark, fn.fact_id(a=F.lit("x"), b=F.lit(1)))

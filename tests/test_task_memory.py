"""What one task holds must not grow with the tables: pairs are dealt before they are grouped."""

import hashlib

from citeloom.operators import analytics as an
from citeloom.operators import quality
from citeloom.plans.views import Views

SF = "/root/testdata/sf0.001"


def below(df, mark):
    """The plan under the topmost operator that is named so; nothing is under an absent one."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split(mark, 1)[1] if mark in plan else "no " + mark


def test_a_large_cell_is_not_sorted_whole(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(quality, "staged", lambda df, name, real=quality.staged: made.setdefault(name, real(df, name)))
    rows = [("big" if i % 50 else "small", f"k{i}") for i in range(5000)] + [("one", "k")]
    got = quality.stratified_sample(spark.createDataFrame(rows, "cell string, k string"), ["cell"], "k", "s1", 3)
    order = lambda c: sorted((hashlib.sha256(f"s1|{k}".encode()).hexdigest(), k) for x, k in rows if x == c)
    assert sorted((r.cell, r.sample_rank, r.k, r.cell_size) for r in got.collect()) == sorted((c, i + 1, k, len(order(c))) for c in ("big", "small", "one") for i, (_, k) in enumerate(order(c)[:3]))
    assert {r.cell: r._cut for r in made["sample-cells"].collect()}["big"] < "010"


def test_grams_are_grouped_where_their_texts_are_dealt(spark):
    d = spark.createDataFrame([(1, "Abcabc"), (1, "xabc"), (2, None), (None, "abc")], "id long, t string")
    got = an.inverted_index(d, "id", "t")
    assert "Aggregate" not in below(got, "Exchange")
    assert sorted(map(tuple, got.where("gram = 'abc'").collect()), key=str) == [("abc", 1, 3, 4), ("abc", None, 1, 1)]


def test_edges_are_dealt_before_they_are_grouped(spark):
    assert "Aggregate" not in (under := below(Views(spark, SF).edges(), "REPARTITION_BY_NUM")) and "no " not in under[:3]


def test_groups_are_dealt_before_they_are_grouped(spark):
    assert "Aggregate" not in (under := below(Views(spark, SF).groups(), "REPARTITION_BY_NUM")) and "no " not in under[:3]


def test_import_checks_reads_the_edges_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for x in batches:
            read.add(x.num_rows)
            yield x

    e = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), ("a", 3), ("a", None)], "source_id string, group_id int").coalesce(1)
    g = spark.createDataFrame([(1, 2), (2, 0), (4, 1)], "group_id int, dd long")
    assert tuple(an.import_checks(e.mapInArrow(count, e.schema), g).first()) == (1, 2, 1)
    assert read.value == 6


def test_ranking_deals_pairs_before_it_tells_sources_apart(spark):
    b = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), ("a", 2)], "source_id string, group_id int")
    got = an.ranking(b, 2, 3)
    assert [tuple(r) for r in got.select("group_id", "filtered_dd").collect()] == [(1, 2), (2, 1)]
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()

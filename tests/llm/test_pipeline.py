"""The pipeline on the small tables, and each of its stages against its operator."""

from pyspark.sql import functions as F

import corpus_pipeline
from citeloom.llm import decontaminate, near_dedup, queries

SF = "/root/testdata/sf0.001"


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        if name != "mixing":
            assert after.columns == docs.columns and after.count() <= before.count()
        before = after.cache()
    assert before.count() > 0
    assert near_dedup.near_classes(docs).where("kept").count() < docs.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_odd_documents_pass_every_stage(spark, odd_docs):
    """Nulls, empty and long texts, ties, repeated rows, extra and clashing columns: no crash, and rows only go for what their own text says."""
    docs = odd_docs.withColumn("n_chars", F.length("text"))
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        if name != "mixing":
            assert after.columns == docs.columns
        if name == "near_duplicates":
            ids = sorted(r.doc_id or 0 for r in after.collect())
            assert {0, 3, 4, 5, 7, 8} <= set(ids) and ids.count(1) == 1 and 2 not in ids
        if name in ("lines", "benchmarks"):
            assert after.count() == docs.count()
        if name == "lines":
            assert {(r.doc_id, r.text, r.n_chars) for r in after.collect()} == {(r.doc_id, r.text, r.n_chars) for r in docs.collect()}


def test_no_benchmark_passage_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    first = bench.orderBy("item_id").first().text
    long_ = docs.limit(5).withColumns({"doc_id": F.col("doc_id") + 10_000_000, "text": F.concat(F.repeat(F.lit("quiet words "), 3000), F.lit(first), F.repeat(F.lit(" more words"), 3000))})
    kept = corpus_pipeline.benchmarks(spark, docs.unionByName(long_), SF)
    assert decontaminate.search(kept, bench).where("n_hit > 0").count() == 0
    clean = decontaminate.search(docs, bench).where("n_hit = 0")
    assert kept.join(clean, "doc_id", "left_semi").count() == clean.count() == kept.count()


def test_a_row_without_id_goes_only_for_its_own_copy(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    rows = [(None, text), (1, text), (None, "quite another text that nothing else in this table has anything to do with, by any measure")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    assert corpus_pipeline.near_duplicates(spark, docs, SF).where("text like 'quite%'").count() == 1


def test_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)

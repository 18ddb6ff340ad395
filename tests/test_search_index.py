"""Stored indexes against scoring everything."""

import random

import numpy as np
from pyspark.sql import functions as F

from citeloom.operators import analytics as an
from citeloom.operators import search_index as si

WORDS = [f"word{i}" for i in range(40)]


def texts(spark, n, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["common"] * rng.randint(0, 3) + [rng.choice(WORDS[: rng.randint(1, 40)]) for _ in range(rng.randint(0, 30))])) for i in range(seed * 10_000, seed * 10_000 + n)]
    return spark.createDataFrame([*rows, (seed * 10_000 + n, None), (seed * 10_000 + n + 1, "")], "id long, text string")


def same(index, docs, question, k):
    got = [tuple(r) for r in index.search(question, k).orderBy("rank").select("id", "score", "rank").collect()]
    want = [tuple(r) for r in an.bm25(docs, question, k, "id", "text").orderBy("rank").select("id", "score", "rank").collect()]
    assert got == want
    return got


def test_stored_words_score_as_all_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(si, "BLOCK", 20)
    a, b = texts(spark, 300, 1), texts(spark, 200, 2)
    index = si.WordIndex(spark, f"{tmp_path}/one")
    index.add(a, "id", "text")
    for question in ("word1 word7, common?", "word39", "nothing such", "Common"):
        same(index, a, question, 10)
    index.add(b, "id", "text")
    both = a.unionByName(b)
    assert same(index, both, "word1 word7, common?", 10)
    merged = index.merge(f"{tmp_path}/two")
    same(merged, both, "word39 word3 common", 1000)
    blocks, _ = merged.selected("common")
    kept, _, _ = merged.kept("common", 5)
    assert 0 < kept.count() < blocks.count()  # blocks that cannot reach the best are left out
    plan = blocks._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    assert merged._postings().where("term = 'common'").count() > 10  # a common word is many rows
    # a segment whose writer died before its totals is not read
    (tmp_path / "two" / "postings" / "segment=dead").mkdir()
    same(merged, both, "word1", 5)


def test_vector_cells_find_most_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (20, 16))
    rows = [(i, [float(x) for x in centres[i % 20] + rng.normal(0, 0.4, 16)]) for i in range(3000)]
    df = spark.createDataFrame([*rows, (9001, None), (9002, [1.0, 2.0]), (None, [0.0] * 16)], "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 50 = 0")
    index = si.VectorIndex(df)
    assert index.rows.count() == 3000  # every row is indexed
    exact = an.knn(df.where("size(embedding) = 16"), asked, 10)
    r = si.recall(index.search(asked, 10), exact).first()
    assert r.queries == 60 and r.recall >= 0.9
    # all cells: exact
    whole = sorted(map(tuple, index.search(asked, 10, probes=len(index.centres)).select("q", "id", "score").collect()))
    assert whole == sorted(map(tuple, exact.select("q", "id", "score").collect()))


def test_vector_grid_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(si, "ROWS_A_BLOCK", 30)
    monkeypatch.setattr(si, "QUERIES_A_BLOCK", 4)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(400)], "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 10 = 0")
    index = si.VectorIndex(df, cells=3)
    got = sorted(map(tuple, index.search(asked, 5, probes=3).select("q", "id", "score", "rank").collect()))
    assert got == sorted(map(tuple, an.knn(df, asked, 5).select("q", "id", "score", "rank").collect()))
    assert si.VectorIndex(df.limit(0)).search(asked, 5).count() == 0

"""The driver's contract, and each query against its SQL in DuckDB on the small tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(d: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
            return None
        return round(float(x), 6) if isinstance(x, (int, float, np.number)) and not isinstance(x, bool) else str(x)

    return sorted((tuple(cell(x) for x in r) for r in d[sorted(d.columns)].itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


@pytest.mark.parametrize("name", sorted(n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith("op") and n != "pipeline"))
def test_other_queries_run(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())

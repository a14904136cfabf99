"""Every catalogued query against its SQL on the small tables."""

import duckdb
import pytest

from siftworks.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_agrees_with_sql(spark, sf, con, name):
    df = catalogue.queries()[name](spark, sf)
    cols = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    want = con.sql(catalogue.oracle_sql()[name])
    assert sorted(want.columns) == cols
    assert rows == sorted((tuple(r[want.columns.index(c)] for c in cols) for r in want.fetchall()), key=repr)


def test_entry_imports():
    import __spark_entry__ as e

    assert set(catalogue.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_scans_read_only_what_is_asked(spark, sf):
    plan = catalogue.queries()["anti_join_index"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan
    plan = catalogue.queries()["size_aspect_filter"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(n_chars,400)" in plan

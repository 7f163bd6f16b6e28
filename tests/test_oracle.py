"""Every query with SQL beside it gives DuckDB's rows on the driver tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SLOW = {"train_regression", "train_classification", "icu_predictions", "train_logistic_cv"}  # see test_ml.py


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(values):
    return tuple("~" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(float(v)) if isinstance(v, float) else str(v) for v in values)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(result.columns)
    order = sorted(df.columns)
    at = [result.columns.index(c) for c in order]
    want = sorted(canonical(r[i] for i in at) for r in result.fetchall())
    got = sorted(canonical(r) for r in df.select(*[f"`{c}`" for c in order]).collect())
    assert got == want
    assert got or name in {"impact_kpis_filtered"}


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_other_queries_give_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_flagship(spark):
    if os.path.isdir(SF):
        assert entry.entry(spark).count() > 0


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 85

"""The correctness gate, locally: every registered query against its DuckDB twin on
the sf0.001 tables (row count, column names, order-insensitive values)."""

import math

import duckdb
import pytest

import __spark_entry__ as ENTRY
from conftest import SF_SMALL
from termlens.plans import catalog, oracle
from termlens.session import TABLES

QUERIES = catalog.QUERIES
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _key(row):
    return tuple((x is None, x) for x in row)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(ENTRY.queries()) and set(SQL) <= set(ENTRY.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    pdf = QUERIES[name](spark, SF_SMALL).toPandas()
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    rows = cur.fetchall()
    assert sorted(cols) == sorted(pdf.columns)
    order = sorted(cols)
    got = sorted((tuple(_norm(x) for x in r) for r in pdf[order].astype(object).itertuples(index=False, name=None)),
                 key=_key)
    want = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in rows), key=_key)
    assert got == want


def test_entry(spark):
    df = ENTRY.entry(spark)
    assert df.columns == ["doc_id", "keywords", "offsets", "contexts"]
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("text is not null").count()

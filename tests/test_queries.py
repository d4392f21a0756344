"""Every facility query against its SQL in DuckDB."""

import os

import duckdb
import pytest

from clinicweave.plans import audits, calendars, checks, namings, places, queries  # noqa: F401

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "documents", "pages", "labels")
QUERIES, ORACLES = queries.QUERIES, queries.ORACLES


def rows(df):
    df = df[sorted(df.columns)]
    clean = df.astype(object).where(df.notna(), None).map(lambda v: round(v, 6) if isinstance(v, float) else v)
    return sorted(map(tuple, clean.values.tolist()), key=str)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{os.path.join(sf_dir, t)}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got, want = QUERIES[name](spark, sf_dir).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)

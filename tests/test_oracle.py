"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlake.plans.catalog import QUERIES
from tools.check_oracle import TABLES, duck_types, norm, spark_types

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_amount" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    sp = sdf.toPandas()
    rel = duck.sql(E.oracle_sql()[name])
    assert spark_types(sdf.schema) == duck_types(rel)
    dd = rel.df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert norm(sp) == norm(dd)

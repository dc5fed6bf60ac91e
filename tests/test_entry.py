"""Driver contract and the DuckDB oracle on the smallest fixture."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import catalog
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 20 and df.columns == ["word", "n"]


def test_every_query_has_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL).toPandas()
    odf = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert digest(sdf) == digest(odf)

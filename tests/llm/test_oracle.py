import duckdb
import pytest

from tessera.llm.queries import oracle_sql, queries
from tests.conftest import SF_SMALL
from tools.oracle_check import digest


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = queries()[name](spark, SF_SMALL).toPandas(), con.sql(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert digest(got) == digest(want)

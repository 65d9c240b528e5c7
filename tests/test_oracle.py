"""Every registered query against its DuckDB oracle on sf0.001 (rows-only
queries just have to run)."""

import duckdb
import pytest

import __spark_entry__ as E
from kiln.session import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare

QUERIES = E.queries()
ORACLE = E.oracle_sql()
#: Queries without SQL whose result is empty on the smallest tables (no phrase is frequent enough, say).
EMPTY_AT_THIS_SIZE: set[str] = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLE:
        assert len(got) > 0 or name in EMPTY_AT_THIS_SIZE
        return
    want = duck.execute(ORACLE[name]).df()
    assert compare(got, want) == "OK"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1 and "r2" in df.columns

"""Queries of the subpackage against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from kiln.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    assert compare(QUERIES[name](spark, SF_SMALL).toPandas(), con.execute(ORACLE[name]).df()) == "OK"


def test_pipeline_is_its_stages(spark):
    """Each stage keeps documents' columns and only its predecessor's ids; the end agrees with the operators' digests."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL).cache()
        now = {r[0] for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= ids, name
        ids = now
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    want = {r["doc_id"]: r["tokens"] for r in last.collect()}
    got = {r["doc_id"]: r["tokens"] for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == want and set(want) == ids

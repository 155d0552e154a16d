"""The queries that SQL can express, against it, on the smallest tables."""

import pytest

from corpusmill.llm import queries

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    found = queries.queries()[name](spark, DATA)
    names = sorted(found.columns)
    wanted = con.sql(queries.oracle_sql()[name])
    at = [wanted.columns.index(c) for c in names]
    assert sorted(wanted.columns) == names
    assert sorted((tuple(r[c] for c in names) for r in found.collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in wanted.fetchall()), key=repr)

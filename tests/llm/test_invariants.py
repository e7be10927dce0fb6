"""The results of the operators on the smallest test tables keep their invariants, which are also checked in SQL."""

import os

import pytest

from strandworks.llm.queries import ORACLE, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_invariants(spark, name):
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    relation = connection.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(tuple(r[i] for i in at) for r in relation.fetchall())

"""Every core query against its SQL, on the smallest test tables."""

import math
import os

import pytest

from strandworks.plans.registry import core_oracle, core_queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return value.isoformat()[:26] if hasattr(value, "isoformat") else repr(value)


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(core_oracle()))
def test_query_equals_its_sql(spark, tables, name):
    df = core_queries()[name](spark, DATA)
    columns = sorted(df.columns)
    relation = tables.sql(core_oracle()[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in relation.fetchall())


def test_the_other_queries_run(spark):
    for name in sorted(set(core_queries()) - set(core_oracle())):
        assert core_queries()[name](spark, DATA).count() > 0, name

"""The queries that SQL can express against their SQL in DuckDB, over whole tables."""

import os

import duckdb
import pytest

from rillsync.llm import queries as Q

DATA = os.environ.get("RILLSYNC_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_oracle(spark, name):
    got = Q.queries()[name](spark, DATA)
    columns, duck = sorted(got.columns), duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cursor = duck.execute(Q.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert want == sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) and want

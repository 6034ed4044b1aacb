"""Every query of the synchroniser against its SQL in DuckDB, over the driver's smallest tables."""

import os

import duckdb
import pytest

from rillsync.plans import queries as Q

DATA = os.environ.get("RILLSYNC_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{DATA}/{t}.parquet"
        c.execute(
            f"CREATE VIEW {t} AS SELECT * FROM '{p}/*.parquet'" if os.path.isdir(p) else f"CREATE VIEW {t} AS SELECT * FROM '{p}'"
        )
    return c


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, duck, name):
    got = Q.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect())))
    cursor = duck.execute(Q.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted(map(repr, (tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall())))
    assert rows == want

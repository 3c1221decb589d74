"""Every query of the engine against its SQL twin on the smallest tables; those without one give a stable schema."""

import os

import duckdb
import pytest

from lodestone.plans import registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sql, name):
    out = registry.queries()[name](spark, FOLDER)
    rows = [tuple(r) for r in out.collect()]
    if twin := registry.oracle_sql().get(name):
        found = sql.execute(twin)
        columns = [c[0] for c in found.description]
        assert plain(rows, out.columns) == plain(found.fetchall(), columns)
    else:
        assert out.columns

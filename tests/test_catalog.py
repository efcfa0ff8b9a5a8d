import datetime
import os

import pytest

import __spark_entry__ as entry_points
from gristmill.plans import catalog, oracles

duckdb = pytest.importorskip("duckdb")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Those of the optional subpackage have tests of their own.
QUERIES = catalog.REGISTRY
SQL = oracles.SQL

@pytest.fixture(scope="module")
def engine(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [
        tuple(r[i].isoformat() if isinstance(r[i], datetime.date) else r[i] for i in order)
        for r in rows
    ]
    return sorted(plain, key=repr)


def test_every_query_is_checked():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, data, engine, name):
    df = QUERIES[name](spark, data)
    found = engine.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.collect(), df.columns) == canonical(found.fetchall(), names)


def test_entry(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    assert entry_points.entry(spark).columns == ["cluster", "n", "avg_l_quantity", "avg_l_extendedprice"]
    assert entry_points.entry(spark).count() == 3

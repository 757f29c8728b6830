"""Every query with SQL against DuckDB, on the smallest tables."""

import duckdb
import pytest

from tessera.plans.bindings import QUERIES
from tessera.plans.oracles import ORACLES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, list | tuple) else value


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, db, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = db.execute(ORACLES[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(found, key=order) == sorted(expected, key=order)

"""Every query against its SQL twin, over the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from spanloom.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    v = v.item() if hasattr(v, "item") else v
    return None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in df.collect())
    rel = db.sql(ORACLES[name])
    names = list(rel.columns)
    assert cols == sorted(names)
    assert rows == sorted(repr(tuple(plain(r[names.index(c)]) for c in cols)) for r in rel.fetchall())


def test_entry_and_registry(spark):
    assert entry_point.entry(spark).limit(5).count() == 5
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())

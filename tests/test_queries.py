"""The registered queries against their SQL, on the smallest driver tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from factpanel.oracle import oracle_sql
from factpanel.queries import BASE_TABLES, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not there")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def cell(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v


def as_bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry_module.queries())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == entry_module.entry(spark).columns
    assert df.count() > 0


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    cursor = db.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert as_bag(df.columns, [tuple(r) for r in df.collect()]) == as_bag(names, cursor.fetchall())

"""Every registered query against its SQL on the smallest tables."""

import math
import os
from collections import Counter

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v if math.isinf(v) else float(f"{v:.10g}")
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SMALL}/{file}'")
    return con


def test_flagship(spark):
    assert entry.entry(spark).count() == 210


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, database, name):
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    if name not in entry.oracle_sql():
        assert got
        return
    cursor = database.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())

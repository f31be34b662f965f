"""Every archive query against its SQL on the smallest tables, as the rows of both engines."""

import os

import duckdb
import pytest

from boardlake.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "documents orders events pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def shown(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return [shown(v) for v in value]
    return bytes(value).hex() if isinstance(value, (bytes, bytearray)) else value


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(str([shown(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_its_sql(spark, oracle, name):
    got = catalog.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name not in catalog.ORACLE_SQL:
        assert got.columns
        return
    want = oracle.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows_of(rows, got.columns) == rows_of(want.fetchall(), columns)

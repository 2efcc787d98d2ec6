"""Every query of the library against its SQL on the smallest data."""

import datetime
import decimal
import math
import os

import duckdb
import pytest
from conftest import SF

from threadloom import registry

TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()


def plain(v):
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, datetime.datetime):
        return str(v)[:26]
    if isinstance(v, datetime.date):
        return f"{v} 00:00:00"
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["cluster_id", "member_count", "max_usefulness", "path"]
    assert os.path.exists(SF)

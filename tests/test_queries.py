"""Every registered query of this part against DuckDB on the smallest tables, and the driver contract."""

import duckdb
import pytest

import __spark_entry__
from brindle.plans import queries as plans

SQL = plans.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, data, name):
    df = plans.queries()[name](spark, data)
    want = duck.sql(SQL[name])
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    at = [want.columns.index(n) for n in names]
    assert _sorted(got) == _sorted(tuple(r[i] for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", ["rt_time_ms", "rt_ts_s", "rt_duration_ms", "rt_datetime_oneway", "rt_events"])
def test_any_time_zone(spark, duck, data, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_query(spark, duck, data, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0

"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import rows_of
from freshet.plans import catalog, stream_catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES = contract.queries()
#: Queries whose results SQL cannot express are held to brute force beside their operators.
WITH_SQL = contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return con


def test_every_query_of_the_warehouse_has_sql():
    assert set(WITH_SQL) <= set(QUERIES)
    assert {*catalog.QUERIES, *stream_catalog.STREAM_QUERIES} <= set(WITH_SQL)


@pytest.mark.parametrize("name", [n for n in WITH_SQL if not n.startswith("stream_")])
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(contract.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["stream_page_multi_dim_5s", "stream_dim_upsert"])
def test_stream_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(contract.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", ["stream_order_users_10s", "stream_coupon_abuse_1h"])
def test_many_files_out_of_time_order_change_nothing(spark, duck, tmp_path, name):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    folder = f"{tmp_path}/events.parquet"
    events.repartition(130, "event_id").write.parquet(folder)
    df = QUERIES[name](spark, str(tmp_path))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(WITH_SQL[name])
    assert got == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0

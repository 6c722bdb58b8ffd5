"""Queries against their SQL on the smallest tables (the driver does it on larger ones)."""

import os

import pytest

from folioforge.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(FOLDER):
        pytest.skip("no tables here")
    c = duckdb.connect()
    for t in os.listdir(FOLDER):
        c.execute(f"create view {t.split('.')[0]} as select * from '{FOLDER}/{t}'")
    return c


@pytest.mark.parametrize("name", list(SQL))
def test_rows(spark, db, tmp_path, name):
    QUERIES[name](spark, FOLDER).write.parquet(f"{tmp_path}/out")
    got = db.sql(f"select * from '{tmp_path}/out/*.parquet'")
    columns = ", ".join(f'"{c}"' for c in sorted(got.columns))
    assert sorted(got.columns) == sorted(db.sql(SQL[name]).columns)
    mine, theirs = f"select {columns} from '{tmp_path}/out/*.parquet'", f"select {columns} from ({SQL[name]})"
    assert db.sql(f"select count(*) from ({mine} except all {theirs})").fetchall() == [(0,)]
    assert db.sql(f"select count(*) from ({theirs} except all {mine})").fetchall() == [(0,)]


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_and_bench_name_queries_that_are_there(spark):
    import __spark_entry__ as e
    import bench

    assert set(bench.HEADLINE) <= set(e.queries())
    if not os.path.isdir(FOLDER):
        pytest.skip("no tables here")
    assert e.entry(spark).count() > 0

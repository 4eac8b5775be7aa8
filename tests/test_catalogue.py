"""Every registered query with SQL gives what DuckDB gives on the same tables."""

import duckdb
import pytest

import __spark_entry__
from tallyline.plans import catalogue

PATH = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{PATH}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_oracle(spark, duck, name):
    frame = catalogue.QUERIES[name](spark, PATH)
    columns = sorted(frame.columns)
    got = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    result = duck.execute(catalogue.ORACLES[name])
    named = [d[0] for d in result.description]
    want = sorted((tuple(r[named.index(c)] for c in columns) for r in result.fetchall()), key=str)
    assert sorted(named) == columns and got == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)


def test_plans_push_down_and_prune(spark):
    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    water = plan(catalogue.QUERIES["dedup_high_water"](spark, PATH))
    assert "GreaterThan(l_linenumber,4)" in water and "l_comment" not in water
    counted = plan(catalogue.QUERIES["dedup_accounting"](spark, PATH))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in counted and "partial_count" in counted
    meta = plan(catalogue.QUERIES["finalize_meta"](spark, PATH))
    assert "NestedLoop" not in meta and "Cartesian" not in meta

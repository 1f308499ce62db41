"""Every query against its SQL on the smallest tables, and plan checks."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from quillspark.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = duck.sql(catalogue.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_has_a_cartesian_product(spark):
    for name, query in catalogue.QUERIES.items():
        if not name.startswith("stream"):
            found = plan(query(spark, SF))
            assert "CartesianProduct" not in found and "BroadcastNestedLoopJoin" not in found, name


def test_filters_and_columns_reach_the_scan(spark):
    found = plan(catalogue.QUERIES["section_fetch"](spark, SF))
    assert "EqualTo(conv_id,7)" in found and "ReadSchema: struct<conv_id:bigint,turn:bigint,role:string,text:string>" in found
    found = plan(catalogue.QUERIES["best_version"](spark, SF))
    assert "o_totalprice" not in found and "WindowGroupLimit" in found
    assert "TakeOrderedAndProject" in plan(catalogue.QUERIES["cosine_topk"](spark, SF))
    assert "BroadcastHashJoin" in plan(catalogue.QUERIES["event_enriched"](spark, SF))


def test_entry_points():
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())

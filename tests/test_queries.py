"""Every named query against its SQL, and what its plan must not contain."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from quoteloom.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    good, text = compare(spark, con, SF, name)
    assert good, text


def test_every_query_has_sql_and_inventory_ids():
    assert set(REGISTRY) <= set(queries()) and set(REGISTRY) <= set(oracle_sql())
    assert all(q.ids for q in REGISTRY.values())


def test_entry(spark):
    assert entry(spark).columns == ["symbol", "date", "open", "high", "low", "close", "volume"]
    assert entry(spark).count() > 0


WRITING = {"bulk_stream_merge"} | {name for name in REGISTRY if name.endswith("_round_trip")}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITING))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow|PythonUDF", plan)


@pytest.mark.parametrize(
    "name, pushed, absent",
    [
        ("date_range_filter", "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00)", "l_tax"),
        ("latest_stored_date", "ReadSchema: struct<l_partkey:bigint,l_shipdate:timestamp_ntz>", "l_orderkey"),
        ("staleness_report", "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>", "o_totalprice"),
        ("portfolio_clean_info", "EqualTo(c_mktsegment,BUILDING)", "o_totalprice"),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, pushed, absent):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert pushed in plan
    assert absent not in plan


@pytest.mark.parametrize("name", ["canslim_score", "bulk_rows_valid", "clean_symbols", "html_table_rows", "attribute_snapshot"])
def test_row_local_queries_group_nothing_of_their_own(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == (1 if name == "canslim_score" else 0)

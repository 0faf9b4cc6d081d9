"""Every registered query against its SQL, on the smallest sample."""

from __future__ import annotations

import importlib
import os

import pytest

from compare import connect, difference
from tillwright.oracle import ORACLE
from tillwright.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_points(spark):
    entry = importlib.import_module("__spark_entry__")
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()
    assert entry.entry(spark).columns == ["product_name", "total_units_sold"]


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], ORACLE[name], FOLDER) is None


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_kpis_push_their_filter_and_read_what_they_need(spark):
    text = plan(QUERIES["kpi_quantity_per_customer"](spark, FOLDER))
    assert "EqualTo(event_type,signup)" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text


def test_daily_report_pushes_its_day(spark):
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in plan(QUERIES["daily_agent_product_units"](spark, FOLDER))


def test_offer_dimension_reads_one_column_and_shuffles_one_row(spark):
    text = plan(QUERIES["dim_offer"](spark, FOLDER))
    assert "ReadSchema: struct<l_discount:double>" in text and text.count("Exchange") == 1
    assert "Expand" not in text


def test_product_dimension_joins_distinct_keys_and_keeps_their_partitioning(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["dim_product"](spark, FOLDER))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("Exchange") == 2
    lines = text[text.index("SortMergeJoin"):]
    assert lines.index("HashAggregate(keys=[l_partkey") < lines.index("FileScan")


def test_windowed_counts_combine_before_the_shuffle(spark):
    text = plan(QUERIES["batch_event_counts"](spark, FOLDER))
    shuffle = text.index("Exchange")
    assert "partial_count" in text[shuffle:] and "partial_count" not in text[:shuffle]
    assert text.count("from_json(") == 1

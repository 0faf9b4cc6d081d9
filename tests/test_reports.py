from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillwright.operators.star import Lookup, sum_by_attributes
from tillwright.plans import kpis, reports
from tillwright.sinks.csv_report import report_folder, write_csv_report
from tillwright.sinks.warehouse import write_fact_folder


def rows(frame):
    return [tuple(row) for row in frame.collect()]


def test_aggregating_below_the_join_keeps_the_result_with_repeated_keys(spark):
    pick = random.Random(3)
    fact = [(pick.choice([1, 1, 1, 2, 3, None, 9]), pick.choice([None, 1, 2, 5])) for _ in range(300)]
    dim = [(1, "a"), (1, "b"), (2, "a"), (3, "c"), (4, "d")]
    expected = Counter()
    counted = Counter()
    for key, units in fact:
        for dim_key, name in dim:
            if key == dim_key:
                expected[name] += units or 0
                counted[name] += units is not None
    result = sum_by_attributes(
        spark.createDataFrame(fact, "k int, units int"),
        [Lookup(spark.createDataFrame(dim, "id int, name string"), "k", "id")],
        ["name"],
        {"units": F.sum("units"), "n": F.count("units")},
    )
    assert {row["name"]: (row["units"], row["n"]) for row in result.collect()} == {
        name: (expected[name], counted[name]) for name in expected
    }


def test_fact_is_aggregated_before_it_is_joined(spark):
    fact = spark.createDataFrame([(1, 2)], "product_id long, units int")
    products = spark.createDataFrame([(1, "lamp", "home")], "product_id long, product_name string, product_category string")
    plan = reports.most_selling_products(fact, products)._jdf.queryExecution().executedPlan().toString()
    below_join = plan[plan.index("Join"):]
    assert "partial_sum(units" in below_join
    assert "TakeOrderedAndProject" in plan


def test_top_and_bottom_break_ties_by_name(spark):
    fact = spark.createDataFrame([(i, 5) for i in range(20)], "product_id long, units int")
    products = spark.createDataFrame([(i, f"p{i:02}") for i in range(20)], "product_id long, product_name string")
    assert [row[0] for row in rows(reports.most_selling_products(fact, products))] == [f"p{i:02}" for i in range(10)]


def test_most_redeemed_by_product_counts_redeemed_sales_only(spark):
    fact = spark.createDataFrame([(1, "5-offer_1"), (1, None), (2, None)], "product_id long, offer_id string")
    products = spark.createDataFrame([(1, "a"), (2, "b")], "product_id long, product_name string")
    assert rows(reports.most_redeemed_offers_by_product(fact, products)) == [("a", 1), ("b", 0)]


def test_lowest_cities_are_online_only_and_need_a_location(spark):
    fact = spark.createDataFrame(
        [("A-x", "yes-Card", 5.0), ("A-y", "yes-Cash", 1.0), ("B-x", "no-Cash", 0.5), ("", "yes-Card", 0.1), ("B-x", "yes-Card", 2.0)],
        "location_id string, payment_id string, total_price double",
    )
    places = spark.createDataFrame([("A-x", "A", "x"), ("A-y", "A", "y"), ("B-x", "B", "x")], "location_id string, city string, state string")
    assert rows(reports.lowest_online_cities(fact, places)) == [("B", 2.0), ("A", 6.0)]


@pytest.fixture
def daily(spark):
    fact = spark.createDataFrame(
        [("2022", "05", "01", 1, 10, 3), ("2022", "05", "01", 1, 11, 4), ("2022", "05", "01", 2, 10, 9), ("2022", "05", "02", 1, 10, 100)],
        "year string, month string, day string, sales_agent_id long, product_id long, units int",
    )
    products = spark.createDataFrame([(10, "lamp"), (11, "lamp")], "product_id long, product_name string")
    agents = spark.createDataFrame([(1, "Ann"), (2, "Bob")], "sales_person_id long, name string")
    return reports.daily_agent_product_units(fact, products, agents, dt.date(2022, 5, 1))


def test_daily_report(daily):
    assert sorted(rows(daily)) == [("Ann", "lamp", 7), ("Bob", "lamp", 9)]


def test_daily_report_reads_one_partition(spark, tmp_path):
    fact = spark.createDataFrame(
        [("20220501", "2022", "05", "01", 1, 10, 3), ("20220502", "2022", "05", "02", 1, 10, 5)],
        "transaction_date_id string, year string, month string, day string, sales_agent_id long, product_id long, units int",
    )
    write_fact_folder(fact, str(tmp_path / "fact"))
    stored = spark.read.schema(fact.schema).parquet(str(tmp_path / "fact"))
    products = spark.createDataFrame([(10, "lamp")], "product_id long, product_name string")
    agents = spark.createDataFrame([(1, "Ann")], "sales_person_id long, name string")
    report = reports.daily_agent_product_units(stored, products, agents, dt.date(2022, 5, 2))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "(day" in plan[plan.index("PartitionFilters"):][:300]
    assert rows(report) == [("Ann", "lamp", 5)]


def test_csv_report_is_one_ordered_file(spark, daily, tmp_path, monkeypatch):
    folder = report_folder(str(tmp_path), dt.date(2022, 5, 1))
    assert folder.endswith("/01-05-2022")
    monkeypatch.setattr("tillwright.sinks.csv_report.work_folder", lambda spark, purpose: str(tmp_path / "staged"))
    for _ in range(2):  # a rerun replaces the report
        assert write_csv_report(daily, folder, reports.daily_report_order()) == 2
    assert not (tmp_path / "staged").exists()
    with pytest.raises(ValueError):
        write_csv_report(daily, folder, reports.daily_report_order(), files="some")
    files = list((tmp_path / "01-05-2022").glob("*.csv"))
    assert [f.read_text() for f in files] == ["sales_agent_name,product_name,total_units_sold\nBob,lamp,9\nAnn,lamp,7\n"]


def test_city_totals_do_not_depend_on_the_order_of_addition(spark):
    amounts = [0.1, 0.2, 0.3, 1e9, -1e9] * 20
    fact = spark.createDataFrame(
        [("A-x", "yes-Card", v) for v in amounts] + [("B-x", "yes-Card", v) for v in reversed(amounts)],
        "location_id string, payment_id string, total_price double",
    ).repartition(7)
    places = spark.createDataFrame([("A-x", "A", "x"), ("B-x", "B", "x")], "location_id string, city string, state string")
    assert rows(reports.lowest_online_cities(fact, places)) == [("A", 12.0), ("B", 12.0)]


def test_long_csv_report_is_several_files_in_order(spark, tmp_path):
    report = spark.range(5000).select(F.col("id").alias("total_units_sold"), F.col("id").cast("string").alias("sales_agent_name"), F.lit("p").alias("product_name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert write_csv_report(report, str(tmp_path / "r"), reports.daily_report_order(), files="many") == 5000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted((tmp_path / "r").glob("*.csv"))
    assert len(files) > 1
    numbers = [int(line.split(",")[0]) for f in files for line in f.read_text().splitlines()[1:]]
    assert numbers == list(range(4999, -1, -1))


def test_kpis_on_empty_and_null(spark):
    purchases = spark.createDataFrame([], "totalAmount double, paymentMethod string")
    assert rows(kpis.total_revenue(purchases)) == [(None,)]
    assert rows(kpis.average_order_value(purchases)) == [(None,)]
    clicks = spark.createDataFrame([("a",), (None,), ("a",)], "customerId string")
    assert rows(kpis.unique_customers_clicking(clicks)) == [(1,)]
    assert rows(kpis.total_recommendation_clicks(clicks)) == [(3,)]


def test_kpi_lists_are_ordered(spark):
    carts = spark.createDataFrame([("c1", 2), ("c2", 5), ("c3", 2), ("c1", None)], "customerId string, quantity int")
    assert rows(kpis.quantity_per_customer(carts)) == [("c2", 5), ("c1", 2), ("c3", 2)]

"""Cleaning, dimensions and fact on rows with edges."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from tillwright.operators import dimensions as dims
from tillwright.operators.cleaning import clean_sales, date_rejects
from tillwright.operators.fact import FACT_COLUMNS, sales_fact, with_date_partitions


def rows(frame, *names):
    return sorted((tuple(row[n] for n in names or frame.columns) for row in frame.collect()), key=repr)


def fact_of(raw):
    return sales_fact(clean_sales(raw))


@pytest.mark.parametrize(
    "given, expected",
    [
        ("a@b.com123", "a@b.com"),
        ("a@b.org", "a@b.org.com"),
        ("x.comp@b.com", "x.com"),
        ("a@b.com", "a@b.com"),
        ("", ".com"),
        (None, None),
    ],
)
def test_mail_address(raw_sales, given, expected):
    assert clean_sales(raw_sales({"cusomter_email": given})).first()["customer_email"] == expected


def test_clean_sales_spells_columns_right(raw_sales):
    names = clean_sales(raw_sales({})).columns
    assert "customer_lname" in names and "customer_email" in names
    assert not [name for name in names if name.startswith("cusomter")]


def test_clean_sales_skips_columns_left_out(raw_sales):
    narrow = clean_sales(raw_sales({}).select("units", "cusomter_lname"))
    assert narrow.columns == ["units", "customer_lname"]


def test_bad_date_is_null_and_rejected_but_still_loads(raw_sales):
    raw = raw_sales(
        {"transaction_id": "bad", "transaction_date": "2022-13-45"},
        {"transaction_id": "good"},
        {"transaction_id": "none", "transaction_date": None},
    )
    assert rows(date_rejects(raw, "transaction_date"), "transaction_id") == [("bad",)]
    fact = with_date_partitions(fact_of(raw))
    assert rows(fact, "transaction_id", "transaction_date_id", "year") == [
        ("bad", None, None), ("good", "20220501", "2022"), ("none", None, None),
    ]


@pytest.mark.parametrize(
    "flags, offer_id, total",
    [
        ({}, None, 59.97),
        ({"offer_3": True}, "15-offer_3", 50.975),
        ({"offer_1": True, "offer_3": True}, None, 59.97),
        ({"offer_2": False}, None, 59.97),
        ({"offer_2": False, "offer_4": True}, "20-offer_4", 47.976),
        ({f"offer_{n}": True for n in range(1, 6)}, None, 59.97),
    ],
)
def test_offers_in_fact(raw_sales, flags, offer_id, total):
    row = fact_of(raw_sales({"units": 3, "unit_price": 19.99, **flags})).first()
    assert (row["offer_id"], row["total_price"]) == (offer_id, total)


def test_offers_against_a_plain_model_for_all_flags(raw_sales):
    cases = list(itertools.product([None, False, True], repeat=5))
    raw = raw_sales(
        *[
            {"transaction_id": str(i), "units": 2, "unit_price": 12.35} | {f"offer_{n + 1}": v for n, v in enumerate(flags)}
            for i, flags in enumerate(cases)
        ]
    )
    got = {row["transaction_id"]: (row["offer_id"], row["total_price"]) for row in fact_of(raw).collect()}
    for i, flags in enumerate(cases):
        redeemed = [n for n in range(5) if flags[n]]
        percent = 5 * (redeemed[0] + 1) if len(redeemed) == 1 else 0
        offer = f"{percent}-offer_{redeemed[0] + 1}" if percent else None
        assert got[str(i)] == (offer, pytest.approx(24.7 * (100 - percent) / 100, abs=5e-4))


def test_offer_dim_counts_present_flags_also_false_ones(raw_sales):
    sales = clean_sales(raw_sales({"offer_2": False}, {"offer_5": True}, {"offer_5": True, "offer_2": True}))
    assert rows(dims.offer_dim(sales)) == [("10-offer_2", "offer_2", 10), ("25-offer_5", "offer_5", 25)]


def test_offer_dim_without_any_flag_is_empty(raw_sales):
    assert dims.offer_dim(clean_sales(raw_sales({}))).count() == 0


def test_offer_dim_is_the_distinct_of_the_unpivoted_flags(raw_sales):
    sales = clean_sales(raw_sales({"offer_2": False}, {"offer_5": True, "offer_1": True}, {}))
    names = dims.offer_flags(sales).select("offer_name").distinct()
    assert rows(names) == rows(dims.offer_dim(sales), "offer_name")
    assert rows(dims.offer_flags(sales, "transaction_id")) == [
        ("t", "offer_1", True), ("t", "offer_2", False), ("t", "offer_5", True),
    ]


@pytest.mark.parametrize(
    "address, key, in_dim",
    [
        (None, "", False),
        ("Main St/Cairo", "Cairo", False),
        ("Main St", "", False),
        ("Main St/Cairo/Giza/123", "Cairo-Giza", True),
    ],
)
def test_location(raw_sales, address, key, in_dim):
    sales = clean_sales(raw_sales({"shipping_address": address}))
    assert sales_fact(sales).first()["location_id"] == key
    assert rows(dims.location_dim(sales), "location_id") == ([(key,)] if in_dim else [])


def test_payment_needs_both_parts(raw_sales):
    sales = clean_sales(raw_sales({}, {"payment_method": None}, {"is_online": None}, {"is_online": "yes"}, {}))
    assert rows(dims.payment_dim(sales)) == [("no-Cash", "no", "Cash"), ("yes-Cash", "yes", "Cash")]
    assert rows(sales_fact(sales), "payment_id") == [("Cash",), ("no",), ("no-Cash",), ("no-Cash",), ("yes-Cash",)]


def test_changed_customer_is_another_row(raw_sales):
    sales = clean_sales(raw_sales({}, {"cusomter_email": "other@mail.com"}, {}))
    assert rows(dims.customer_dim(sales), "customer_id", "customer_email") == [
        (1, "ann@mail.com"), (1, "other@mail.com"),
    ]


def test_fact_is_a_projection_and_can_be_narrow(raw_sales):
    sales = clean_sales(raw_sales({}))
    fact = sales_fact(sales)
    assert fact.columns == list(FACT_COLUMNS)
    assert "Exchange" not in fact._jdf.queryExecution().executedPlan().toString()
    assert sales_fact(sales.select("units", "product_id"), ["product_id", "units"]).columns == ["product_id", "units"]


def test_calendar_is_complete(spark):
    days = dims.date_dim(dims.calendar(spark))
    assert days.count() == 4018
    first = days.orderBy("value").first()
    assert first.asDict() == {
        "value": dt.date(2020, 1, 1), "date_id": "20200101", "day": 1, "month": 1, "year": 2020, "quarter": 1,
        "day_name": "Wednesday",
    }
    assert days.agg(F.max("date_id")).first()[0] == "20301231"


def test_calendar_of_sales_spans_first_to_last(raw_sales):
    sales = clean_sales(raw_sales({"transaction_date": "2022-02-27"}, {"transaction_date": "2022-03-02"}))
    assert [row["date_id"] for row in dims.date_dim(dims.calendar_of(sales)).orderBy("value").collect()] == [
        "20220227", "20220228", "20220301", "20220302",
    ]


def test_branch_and_agent_dates(spark):
    branches = spark.createDataFrame([(1, "x", "2020-02-30", "A"), (2, "y", "2020-02-29", "B")],
                                     "branch_id long, location string, establish_date string, class string")
    assert rows(dims.branches_dim(branches), "establish_date") == [(None,), (dt.date(2020, 2, 29),)]
    agents = spark.createDataFrame([(1, "x", "2020-01-05")], "sales_person_id long, name string, hire_date string")
    assert dims.sales_agents_dim(agents).first()["hire_date"] == dt.date(2020, 1, 5)

"""Marketing reports and the daily report per agent and product.

Ties are broken by name, so that a report is the same on every run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.operators.star import Lookup, sum_by_attributes

# Lengths of the marketing reports, and what an online payment key starts with.
MOST_SELLING = 10
MOST_REDEEMED = 5
LOWEST_CITIES = 10
ONLINE = "yes"


def most_selling_products(fact: DataFrame, products: DataFrame, rows: int = MOST_SELLING) -> DataFrame:
    """Units sold by product name, highest first."""
    sold = sum_by_attributes(
        fact,
        [Lookup(products, "product_id", "product_id")],
        ["product_name"],
        {"total_units_sold": F.sum("units")},
    )
    return sold.orderBy(F.desc("total_units_sold"), "product_name").limit(rows)


def most_redeemed_offers(fact: DataFrame, offers: DataFrame, rows: int = MOST_REDEEMED) -> DataFrame:
    """Sales by redeemed offer, highest first."""
    redeemed = sum_by_attributes(
        fact,
        [Lookup(offers, "offer_id", "offer_id")],
        ["offer_name"],
        {"total_redeemed_offer": F.count("offer_id")},
    )
    return redeemed.orderBy(F.desc("total_redeemed_offer"), "offer_name").limit(rows)


def most_redeemed_offers_by_product(fact: DataFrame, products: DataFrame, rows: int = MOST_REDEEMED) -> DataFrame:
    """Sales with a redeemed offer by product name, highest first."""
    redeemed = sum_by_attributes(
        fact,
        [Lookup(products, "product_id", "product_id")],
        ["product_name"],
        {"total_redeemed_offer": F.count("offer_id")},
    )
    return redeemed.orderBy(F.desc("total_redeemed_offer"), "product_name").limit(rows)


def lowest_online_cities(fact: DataFrame, locations: DataFrame, rows: int = LOWEST_CITIES) -> DataFrame:
    """Online sales by city, lowest first.

    Prices have three places, so they add up exactly as decimals and a rank does not depend on the
    order of addition.
    """
    sales = sum_by_attributes(
        fact.where(F.col("payment_id").startswith(ONLINE)),
        [Lookup(locations, "location_id", "location_id")],
        ["city"],
        {"total_online_sales": F.sum(F.col("total_price").cast("decimal(28,3)"))},
    )
    lowest = sales.orderBy("total_online_sales", "city").limit(rows)
    return lowest.withColumn("total_online_sales", F.col("total_online_sales").cast("double"))


def daily_agent_product_units(fact: DataFrame, products: DataFrame, agents: DataFrame, day: dt.date) -> DataFrame:
    """Units sold on one day by agent and product name; the day prunes fact partitions."""
    on_day = fact.where(
        (F.col("year") == f"{day:%Y}") & (F.col("month") == f"{day:%m}") & (F.col("day") == f"{day:%d}")
    )
    return sum_by_attributes(
        on_day,
        [Lookup(products, "product_id", "product_id"), Lookup(agents.withColumnRenamed("name", "sales_agent_name"), "sales_agent_id", "sales_person_id")],
        ["sales_agent_name", "product_name"],
        {"total_units_sold": F.sum("units")},
    )


def daily_report_order() -> list[Column]:
    return [F.desc("total_units_sold"), F.asc("sales_agent_name"), F.asc("product_name")]

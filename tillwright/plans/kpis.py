"""The twelve KPIs over the routed event tables.

Lists are ordered by their measure, highest first, and then by their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ranking(table: DataFrame, key: str, name: str, measure: Column) -> DataFrame:
    return table.groupBy(key).agg(measure.alias(name)).orderBy(F.desc(name), key)


def _rows() -> Column:
    return F.count(F.lit(1))


# product views


def total_product_views(views: DataFrame) -> DataFrame:
    return views.agg(_rows().alias("total_product_views"))


def views_per_category(views: DataFrame) -> DataFrame:
    return _ranking(views, "category", "views_per_category", _rows())


def unique_customers_per_category(views: DataFrame) -> DataFrame:
    return _ranking(views, "category", "unique_customers", F.count_distinct("customerId"))


# carts


def total_add_to_cart(carts: DataFrame) -> DataFrame:
    return carts.agg(_rows().alias("total_add_to_cart"))


def add_to_cart_per_product(carts: DataFrame) -> DataFrame:
    return _ranking(carts, "productId", "add_to_cart_per_product", _rows())


def quantity_per_customer(carts: DataFrame) -> DataFrame:
    return _ranking(carts, "customerId", "total_quantity_added", F.sum("quantity"))


# purchases


def total_revenue(purchases: DataFrame) -> DataFrame:
    return purchases.agg(F.sum("totalAmount").alias("total_revenue"))


def purchases_per_method(purchases: DataFrame) -> DataFrame:
    return _ranking(purchases, "paymentMethod", "purchases_per_method", _rows())


def average_order_value(purchases: DataFrame) -> DataFrame:
    return purchases.agg(F.avg("totalAmount").alias("average_order_value"))


# recommendations


def total_recommendation_clicks(clicks: DataFrame) -> DataFrame:
    return clicks.agg(_rows().alias("total_recommendation_clicks"))


def clicks_per_algorithm(clicks: DataFrame) -> DataFrame:
    return _ranking(clicks, "algorithm", "clicks_per_algorithm", _rows())


def unique_customers_clicking(clicks: DataFrame) -> DataFrame:
    return clicks.agg(F.count_distinct("customerId").alias("unique_customers_clicking"))


# Names of the KPIs; with each, the routed table it reads.
KPIS = {
    "total_product_views": ("product_view", total_product_views),
    "views_per_category": ("product_view", views_per_category),
    "unique_customers_per_category": ("product_view", unique_customers_per_category),
    "total_add_to_cart": ("add_to_cart", total_add_to_cart),
    "add_to_cart_per_product": ("add_to_cart", add_to_cart_per_product),
    "quantity_per_customer": ("add_to_cart", quantity_per_customer),
    "total_revenue": ("purchase", total_revenue),
    "purchases_per_method": ("purchase", purchases_per_method),
    "average_order_value": ("purchase", average_order_value),
    "total_recommendation_clicks": ("recommendation_click", total_recommendation_clicks),
    "clicks_per_algorithm": ("recommendation_click", clicks_per_algorithm),
    "unique_customers_clicking": ("recommendation_click", unique_customers_clicking),
}

"""The eight dimensions of the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.functions import OFFER_PERCENTAGES, address_field, date_id, natural_key
from tillwright.operators.cleaning import with_date

# Dimension tables and the key each is loaded by.
DIMENSION_KEYS = {
    "branches_Dim": "branch_id",
    "sales_agents_Dim": "sales_person_id",
    "customer_Dim": "customer_id",
    "location_Dim": "location_id",
    "payment_Dim": "payment_id",
    "product_Dim": "product_id",
    "offer_Dim": "offer_id",
}

# First and last day of the calendar.
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)


def branches_dim(raw: DataFrame) -> DataFrame:
    return with_date(raw, "establish_date")


def sales_agents_dim(raw: DataFrame) -> DataFrame:
    return with_date(raw, "hire_date")


def customer_dim(sales: DataFrame) -> DataFrame:
    """One row per distinct customer record; a changed record is another row."""
    return sales.select("customer_id", "customer_fname", "customer_lname", "customer_email").distinct()


def product_dim(sales: DataFrame) -> DataFrame:
    return sales.select("product_id", "product_name", "product_category").distinct()


def location_dim(sales: DataFrame) -> DataFrame:
    """Cities that goods were shipped to; addresses without city or state have none."""
    return _locations_of(sales.select(*_place()))


def _place() -> list[Column]:
    return [address_field(F.col("shipping_address"), field).alias(field) for field in ("city", "state")]


def _locations_of(places: DataFrame) -> DataFrame:
    return (
        places.select("city", "state")
        .dropna("any")
        .distinct()
        .select(natural_key(F.col("city"), F.col("state")).alias("location_id"), "city", "state")
    )


def payment_dim(sales: DataFrame) -> DataFrame:
    return (
        sales.select("is_online", "payment_method")
        .dropna("any")
        .distinct()
        .select(natural_key(F.col("is_online"), F.col("payment_method")).alias("payment_id"), "is_online", "payment_method")
    )


def offer_flags(sales: DataFrame, *keep: str) -> DataFrame:
    """Offer columns to rows: one ``(offer_name, offer_value)`` per flag that is present."""
    return sales.unpivot(list(keep), list(OFFER_PERCENTAGES), "offer_name", "offer_value").where(
        F.col("offer_value").isNotNull()
    )


def offer_dim(sales: DataFrame) -> DataFrame:
    """Offers with any flag present, true or false.

    The flags collapse to one row of counts before that row becomes one per offer, so the sales
    are neither multiplied by the number of offers nor shuffled.
    """
    present = sales.agg(*[F.count(flag).alias(flag) for flag in OFFER_PERCENTAGES])
    offers = [
        F.struct(
            natural_key(F.lit(percentage), F.lit(name)).alias("offer_id"),
            F.lit(name).alias("offer_name"),
            F.lit(percentage).alias("percentage"),
            F.col(name).alias("present"),
        )
        for name, percentage in OFFER_PERCENTAGES.items()
    ]
    return present.select(F.inline(F.array(*offers))).where(F.col("present") > 0).drop("present")


def date_dim(days: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with one date column, ``value``."""
    day = F.col("value")
    return days.select(
        day,
        date_id(day).alias("date_id"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def calendar(spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END) -> DataFrame:
    """Every day from ``start`` to ``end``, generated by Spark."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return _days(bounds)


def calendar_of(sales: DataFrame, column: str = "transaction_date") -> DataFrame:
    """Every day from the first to the last date in a column."""
    return _days(sales.agg(F.min(column).alias("first"), F.max(column).alias("last")))


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", "last")).alias("value"))


_PARTS = {
    "customer": ("customer_id", "customer_fname", "customer_lname", "customer_email"),
    "product": ("product_id", "product_name", "product_category"),
    "other": ("offers", "city", "state", "is_online", "payment_method"),
}
#: Columns of the parts: a number and texts, whatever each part has in them.
_NUMBER, _TEXTS = "number", ("text_1", "text_2", "text_3", "text_4")


def dimension_parts(sales: DataFrame) -> DataFrame:
    """What the dimensions need of the clean sales, in one pass over them.

    The distinct customers, products, and combinations of place, payment and offers present (a bit for each),
    each as rows of the same few columns, as rows are compared and shuffled with all they have.  Tasks combine
    equal rows before the shuffle, so what is shuffled and kept is about as large as the dimensions.
    """
    bits = [F.when(F.col(flag).isNotNull(), F.lit(1 << n)).otherwise(0) for n, flag in enumerate(OFFER_PERCENTAGES)]
    made = sales.select("*", *_place(), sum(bits, F.lit(0)).cast("long").alias("offers"), F.lit(None).cast("string").alias("none"))
    sets = [[*names, *["none"] * (1 + len(_TEXTS) - len(names))] for names in _PARTS.values()]
    rows = ", ".join(f"({', '.join(names)}) AS `{part}`" for part, names in zip(_PARTS, sets))
    columns = ", ".join((_NUMBER, *_TEXTS))
    return sales.sparkSession.sql(
        f"SELECT DISTINCT part, {columns} FROM {{made}} UNPIVOT INCLUDE NULLS (({columns}) FOR part IN ({rows}))", made=made
    )


def dimensions_of_parts(parts: DataFrame) -> dict[str, DataFrame]:
    """:func:`transaction_dimensions` of the sales that :func:`dimension_parts` was made from."""

    def of(part: str) -> DataFrame:
        named = [F.col(column).alias(name) for column, name in zip((_NUMBER, *_TEXTS), _PARTS[part])]
        return parts.where(F.col("part") == part).select(*named)

    flags = [F.when(F.col("offers").bitwiseAND(1 << n) != 0, True).alias(flag) for n, flag in enumerate(OFFER_PERCENTAGES)]
    return {
        "customer_Dim": of("customer"),
        "location_Dim": _locations_of(of("other")),
        "payment_Dim": payment_dim(of("other")),
        "product_Dim": of("product"),
        "offer_Dim": offer_dim(of("other").select(*flags)),
    }


def transaction_dimensions(sales: DataFrame) -> dict[str, DataFrame]:
    """The dimensions that are read off the clean sales."""
    return {
        "customer_Dim": customer_dim(sales),
        "location_Dim": location_dim(sales),
        "payment_Dim": payment_dim(sales),
        "product_Dim": product_dim(sales),
        "offer_Dim": offer_dim(sales),
    }

"""The sales fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions import (
    OFFER_PERCENTAGES,
    address_field,
    date_id,
    date_parts,
    discounted_total,
    natural_key,
    redeemed_offer,
)

DATE_PARTITIONS = ("year", "month", "day")


# Fact columns in order, with the columns of the clean sales each is made from.
_OFFERS = tuple(OFFER_PERCENTAGES)
FACT_COLUMNS = {
    "transaction_id": ("transaction_id",),
    "transaction_date_id": ("transaction_date",),
    "customer_id": ("customer_id",),
    "sales_agent_id": ("sales_agent_id",),
    "branch_id": ("branch_id",),
    "product_id": ("product_id",),
    "location_id": ("shipping_address",),
    "payment_id": ("is_online", "payment_method"),
    "offer_id": _OFFERS,
    "units": ("units",),
    "unit_price": ("unit_price",),
    "total_price": ("units", "unit_price", *_OFFERS),
}


def sales_fact(sales: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Clean sales to fact rows, or to some columns of them: a projection without shuffle.

    Sales without an address get the location key ``''``.
    """
    address = F.col("shipping_address")
    offer_id, percentage = redeemed_offer()
    made = {
        "transaction_date_id": date_id(F.col("transaction_date")),
        "location_id": natural_key(address_field(address, "city"), address_field(address, "state")),
        "payment_id": natural_key(F.col("is_online"), F.col("payment_method")),
        "offer_id": offer_id,
        "total_price": discounted_total(F.col("units"), F.col("unit_price"), percentage),
    }
    return sales.select(*[made.get(name, F.col(name)).alias(name) for name in columns or FACT_COLUMNS])


def with_date_partitions(fact: DataFrame) -> DataFrame:
    return fact.withColumns(date_parts(F.col("transaction_date_id")))

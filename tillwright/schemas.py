"""Declared schemas: raw CSV groups, the event superset and the routed event tables.

Nothing is inferred.  Dates arrive as text and are cast while cleaning, so that a
malformed one can be reported instead of failing the scan.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, INT, LONG, DOUBLE, FLAG, TIME = (
    StringType(), IntegerType(), LongType(), DoubleType(), BooleanType(), TimestampType()
)


def _struct(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Column names of the source system's files, misspellings included.
BRANCHES_RAW = _struct(branch_id=LONG, location=TEXT, establish_date=TEXT, **{"class": TEXT})

SALES_AGENTS_RAW = _struct(sales_person_id=LONG, name=TEXT, hire_date=TEXT)

SALES_TRANSACTIONS_RAW = _struct(
    transaction_id=TEXT,
    transaction_date=TEXT,
    customer_id=LONG,
    customer_fname=TEXT,
    cusomter_lname=TEXT,
    cusomter_email=TEXT,
    sales_agent_id=LONG,
    branch_id=LONG,
    product_id=LONG,
    product_name=TEXT,
    product_category=TEXT,
    offer_1=FLAG,
    offer_2=FLAG,
    offer_3=FLAG,
    offer_4=FLAG,
    offer_5=FLAG,
    units=INT,
    unit_price=DOUBLE,
    is_online=TEXT,
    payment_method=TEXT,
    shipping_address=TEXT,
)

RAW_GROUPS = {
    "branches": BRANCHES_RAW,
    "sales_agents": SALES_AGENTS_RAW,
    "sales_transactions": SALES_TRANSACTIONS_RAW,
}

# Every field any shop event may carry; an event fills the ones of its type.
EVENT = _struct(
    eventType=TEXT,
    customerId=TEXT,
    productId=TEXT,
    timestamp=TIME,
    metadata=MapType(TEXT, TEXT),
    quantity=INT,
    totalAmount=DOUBLE,
    paymentMethod=TEXT,
    recommendedProductId=TEXT,
    algorithm=TEXT,
)

# The routed tables, by name, with their columns.
ROUTED_TABLES = {
    "product_view": _struct(
        eventType=TEXT, customerId=TEXT, productId=TEXT, timestamp=TIME, category=TEXT, source=TEXT
    ),
    "add_to_cart": _struct(eventType=TEXT, customerId=TEXT, productId=TEXT, timestamp=TIME, quantity=INT),
    "purchase": _struct(
        eventType=TEXT,
        customerId=TEXT,
        productId=TEXT,
        timestamp=TIME,
        quantity=INT,
        totalAmount=DOUBLE,
        paymentMethod=TEXT,
    ),
    "recommendation_click": _struct(
        eventType=TEXT, customerId=TEXT, recommendedProductId=TEXT, algorithm=TEXT, timestamp=TIME
    ),
}

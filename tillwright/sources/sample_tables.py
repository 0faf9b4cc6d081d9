"""Raw-shaped frames over the sample tables (an order schema and an event log).

Each raw column is a fixed expression over the sample tables.  All joins are to the
unique key of the joined table and keep every left row, so a join whose columns are not
asked for can be left out without changing the result: ``raw_sales`` only performs the
ones it needs.  Orders meet customers before they meet line items, which shuffles the
smaller side.  No join is hinted; Spark broadcasts by measured size and splits skewed
partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.schemas import ROUTED_TABLES, SALES_TRANSACTIONS_RAW

# Fixed values of the mapping.
PAYMENT_METHODS = {
    "1-URGENT": "Cash",
    "2-HIGH": "Card",
    "3-MEDIUM": "PayPal",
    "4-NOT SPECIFIED": "Transfer",
    "5-LOW": "Wallet",
}
EVENT_TYPES = {
    "view": "productView",
    "signup": "addToCart",
    "purchase": "purchase",
    "click": "recommendationClick",
    "error": "error",
}
SAMPLE_TYPE_OF_TABLE = {
    "product_view": "view",
    "add_to_cart": "signup",
    "purchase": "purchase",
    "recommendation_click": "click",
}


#: Schemas by path and state of the file.  Reading one off the footers is a Spark job; a query reads a table
#: more than once.
_schemas: dict[tuple, StructType] = {}


def sample_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file)
    state = (path, status.getModificationTime(), status.getLen())
    if state not in _schemas:
        _schemas[state] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[state]).parquet(path)


# --- sales -----------------------------------------------------------------------------

_CUSTOMER_COLUMNS = {"customer_fname", "cusomter_lname", "cusomter_email"}
_ORDER_COLUMNS = {"transaction_date", "customer_id", "is_online", "payment_method", "shipping_address"}
_PART_COLUMNS = {"product_name", "product_category", "unit_price"}

#: Line item column that a raw column is made from.
_LINE_SOURCES = {
    "transaction_id": "l_orderkey",
    "sales_agent_id": "l_suppkey",
    "product_id": "l_partkey",
    "units": "l_quantity",
    **{f"offer_{n}": "l_discount" for n in range(1, 6)},
}


def raw_sales(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] | None = None,
    day: dt.date | None = None,
    as_set: bool = False,
) -> DataFrame:
    """Line items in the shape of the raw sales group; ``day`` keeps one order date.

    ``as_set`` is for readers that only look at distinct rows.  Line items are then cut
    down to the distinct values that are needed of them before anything is joined, so a
    product or order with a third of all lines is one row in the joins.
    """
    wanted = columns or SALES_TRANSACTIONS_RAW.names
    need = set(wanted)
    with_orders = bool(day or need & (_ORDER_COLUMNS | _CUSTOMER_COLUMNS))
    with_parts = bool(need & _PART_COLUMNS)
    with_suppliers = "branch_id" in need

    rows = sample_table(spark, sf_dir, "lineitem")
    if as_set:
        keys = {"l_orderkey": with_orders, "l_partkey": with_parts, "l_suppkey": with_suppliers}
        used = {key for key, joined in keys.items() if joined} | {_LINE_SOURCES[n] for n in need if n in _LINE_SOURCES}
        rows = rows.select(*sorted(used)).distinct()
    if with_orders:
        orders = _orders(spark, sf_dir, need, day).withColumnRenamed("o_orderkey", "l_orderkey")
        rows = rows.join(orders, "l_orderkey", "inner" if day else "left")
    if with_parts:
        rows = rows.join(_parts(spark, sf_dir), "l_partkey", "left")
    if with_suppliers:
        suppliers = sample_table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("branch_id")
        )
        rows = rows.join(suppliers, "l_suppkey", "left")

    own = _line_columns()
    types = {field.name: field.dataType for field in SALES_TRANSACTIONS_RAW.fields}
    return rows.select(*[own.get(name, F.col(name)).cast(types[name]).alias(name) for name in wanted])


def _line_columns() -> dict[str, Column]:
    discount = F.col("l_discount")
    return {
        "transaction_id": F.col("l_orderkey"),
        "sales_agent_id": F.col("l_suppkey"),
        "product_id": F.col("l_partkey"),
        "offer_1": F.when(discount.isin(0.01, 0.02, 0.1), True),
        "offer_2": F.when(discount.isin(0.03, 0.04), True),
        "offer_3": F.when(discount.isin(0.05, 0.06), True),
        "offer_4": F.when(discount.isin(0.07, 0.08), True),
        "offer_5": F.when(discount.isin(0.09, 0.1), True).when(discount == 0.0, False),
        "units": F.col("l_quantity"),
    }


def _orders(spark: SparkSession, sf_dir: str, need: set[str], day: dt.date | None) -> DataFrame:
    """Order keys with the needed columns; they are made once per order, not once per line."""
    orders = sample_table(spark, sf_dir, "orders")
    if day:
        ordered = F.col("o_orderdate")
        first, next_first = [F.lit(str(date)).cast("timestamp_ntz") for date in (day, day + dt.timedelta(days=1))]
        orders = orders.where((ordered >= first) & (ordered < next_first))
    if need & _CUSTOMER_COLUMNS or "shipping_address" in need:
        orders = orders.join(_customers(spark, sf_dir), "o_custkey", "left")
    if "shipping_address" in need:
        orders = orders.join(_places(spark, sf_dir).withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", "left")
    online, customer = F.col("o_orderstatus") == "O", F.col("o_custkey")
    payment = F.coalesce(*[F.when(F.col("o_orderpriority") == k, v) for k, v in PAYMENT_METHODS.items()])
    own = {
        "transaction_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "customer_id": customer,
        "is_online": F.when(online, "yes").otherwise("no"),
        "payment_method": payment,
        "shipping_address": F.when(
            online,
            F.concat_ws("/", F.lit("Street"), "n_name", "r_name", (F.lit(10000) + customer).cast("string")),
        ),
    }
    names = [name for name in SALES_TRANSACTIONS_RAW.names if name in need & (_ORDER_COLUMNS | _CUSTOMER_COLUMNS)]
    return orders.select("o_orderkey", *[own.get(name, F.col(name)).alias(name) for name in names])


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    mail = F.concat(F.lit("c"), key, F.lit("@mail"))
    return sample_table(spark, sf_dir, "customer").select(
        key.alias("o_custkey"),
        "c_nationkey",
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("customer_fname"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("cusomter_lname"),
        F.when(key % 4 == 1, F.concat(mail, F.lit(".com")))
        .when(key % 4 == 2, F.concat(mail, F.lit(".com77")))
        .when(key % 4 == 3, F.concat(mail, F.lit(".org")))
        .alias("cusomter_email"),
    )


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = sample_table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return sample_table(spark, sf_dir, "nation").join(regions, "n_regionkey", "left")


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as branches; the branch with id 13 has a date that is none."""
    key = F.col("n_nationkey")
    established = F.date_add(F.lit(dt.date(2000, 1, 1)), key * 100).cast("string")
    return _places(spark, sf_dir).select(
        key.cast("long").alias("branch_id"),
        F.col("n_name").alias("location"),
        F.when(key == 13, "2001-13-45").otherwise(established).alias("establish_date"),
        F.col("r_name").alias("class"),
    )


def raw_sales_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return sample_table(spark, sf_dir, "supplier").select(
        key.alias("sales_person_id"),
        F.col("s_name").alias("name"),
        F.date_add(F.lit(dt.date(2015, 1, 1)), (key % 1000).cast("int")).cast("string").alias("hire_date"),
    )


# --- events ----------------------------------------------------------------------------


def _event_fields() -> dict[str, Column]:
    """Event fields by name, each NULL on events that do not carry it."""
    kind, number = F.col("event_type"), F.col("event_id")
    product = F.get_json_object("props", "$.k")

    def on(*kinds: str):
        return lambda column: F.when(kind.isin(*kinds), column)

    return {
        "eventType": F.coalesce(*[F.when(kind == sample, name) for sample, name in EVENT_TYPES.items()]),
        "customerId": F.col("user_id").cast("string"),
        "productId": on("view", "signup", "purchase", "error")(product),
        "timestamp": F.col("ts"),
        "category": on("view")(F.concat(F.lit("cat"), product.cast("int") % 5)),
        "source": on("view")(F.concat(F.lit("src"), number % 3)),
        "quantity": on("signup", "purchase")((1 + number % 5).cast("int")),
        "totalAmount": on("purchase")(F.col("value")),
        "paymentMethod": on("purchase")(F.concat(F.lit("pm"), number % 3)),
        "recommendedProductId": on("click")(product),
        "algorithm": on("click")(F.concat(F.lit("alg"), product.cast("int") % 3)),
    }


def event_messages(events: DataFrame) -> DataFrame:
    """Event log rows as JSON messages; a message only has the fields of its type."""
    fields = _event_fields()
    fields["timestamp"] = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    category, source = fields.pop("category"), fields.pop("source")
    columns = [column.alias(name) for name, column in fields.items()]
    metadata = F.when(
        F.col("event_type") == "view",
        F.struct(category.alias("category"), source.alias("source")),
    ).alias("metadata")
    return events.select(F.to_json(F.struct(*columns, metadata)).alias("value"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log as a stream of messages.

    The pattern lets the log be one file or a folder of files.
    """
    schema = sample_table(spark, sf_dir, "events").schema
    return event_messages(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(sample_table(spark, sf_dir, "events"))


def routed_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Stand-in for a stored routed table: filter and columns reach the parquet scan."""
    fields = _event_fields()
    kept = sample_table(spark, sf_dir, "events").where(F.col("event_type") == SAMPLE_TYPE_OF_TABLE[table])
    return kept.select(
        *[fields[field.name].cast(field.dataType).alias(field.name) for field in ROUTED_TABLES[table].fields]
    )

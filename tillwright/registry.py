"""Every operator as a query over the sample tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators import dimensions as dims
from tillwright.operators.cleaning import clean_sales
from tillwright.operators.fact import DATE_PARTITIONS, FACT_COLUMNS, sales_fact, with_date_partitions
from tillwright.operators.incremental import new_rows
from tillwright.operators.key_checks import key_violations, unique_keys
from tillwright.plans import reports
from tillwright.plans.hourly_load import load_hour, load_hour_dimensions
from tillwright.plans.kpis import KPIS
from tillwright.schemas import EVENT, ROUTED_TABLES, SALES_TRANSACTIONS_RAW
from tillwright.session import stateful_session, work_folder
from tillwright.sinks.compaction import compact_folder, compact_new_files, compact_run
from tillwright.sinks.csv_report import report_folder, write_csv_report
from tillwright.sinks.warehouse import (
    DATE_TABLE,
    FACT_TABLE,
    Warehouse,
    register_compacted,
    register_event_tables,
    write_fact_folder,
)
from tillwright.sources import sample_feed as feed
from tillwright.sources import sample_tables as sample
from tillwright.sources.events import event_source
from tillwright.sources.raw_zone import (
    COMPRESSION,
    HOUR,
    hour_path,
    land_group,
    land_hour,
    read_group,
    read_raw_zone,
    write_csv,
)
from tillwright.streaming import late_rows, parse, queries, serving, window_counts

Query = Callable[[SparkSession, str], DataFrame]

#: Sales before this day count as stored in the incremental queries.
STORED_BEFORE = dt.date(1995, 7, 1)
#: Branches and agents from before these days count as stored.
BRANCHES_BEFORE = dt.date(2003, 1, 1)
AGENTS_BEFORE = dt.date(2015, 2, 15)
#: Day of the daily report.
REPORT_DAY = dt.date(1997, 1, 1)
#: When the landing and loading queries pretend to run.
AS_OF = dt.datetime(2024, 5, 1, 10, 20)
#: State partitions of the stateful queries.
STATE_PARTITIONS = 8
#: Drops in which the event log reaches the stateful queries.
DROPS = 3


# --- inputs ----------------------------------------------------------------------------

_CUSTOMER = ("customer_id", "customer_fname", "cusomter_lname", "cusomter_email")
_PRODUCT = ("product_id", "product_name", "product_category")


def _sales(spark: SparkSession, sf_dir: str, *columns: str, **how) -> DataFrame:
    """Clean sales with the given raw columns, or all."""
    return clean_sales(sample.raw_sales(spark, sf_dir, list(columns) or None, **how))


def _distinct_sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Clean sales for dimensions, which keep distinct rows anyway."""
    return _sales(spark, sf_dir, *columns, as_set=True)


def _fact(spark: SparkSession, sf_dir: str, *columns: str, day: dt.date | None = None) -> DataFrame:
    """The fact, or the given columns of it from just the raw columns they need."""
    names = list(columns) or list(FACT_COLUMNS)
    needed = {source for name in names for source in FACT_COLUMNS[name]}
    raw = [name for name in SALES_TRANSACTIONS_RAW.names if name in needed]
    return sales_fact(_sales(spark, sf_dir, *raw, day=day), names)


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.product_dim(_distinct_sales(spark, sf_dir, *_PRODUCT))


def _locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.location_dim(_distinct_sales(spark, sf_dir, "shipping_address"))


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.payment_dim(_distinct_sales(spark, sf_dir, "is_online", "payment_method"))


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.offer_dim(_sales(spark, sf_dir, *dims.OFFER_PERCENTAGES))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.customer_dim(_distinct_sales(spark, sf_dir, *_CUSTOMER))


def _branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.branches_dim(sample.raw_branches(spark, sf_dir))


def _agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.sales_agents_dim(sample.raw_sales_agents(spark, sf_dir))


def _wall_clock(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, as the event log has them."""
    return rows.withColumns(
        {f.name: F.col(f.name).cast("timestamp_ntz") for f in rows.schema.fields if f.dataType.typeName() == "timestamp"}
    )


# --- cleaning, dimensions, fact --------------------------------------------------------


def clean_sales_query(spark, sf_dir):
    return _sales(spark, sf_dir)


def dim_date(spark, sf_dir):
    """The calendar from the first to the last day with an order."""
    orders = sample.sample_table(spark, sf_dir, "orders")
    return dims.date_dim(dims.calendar_of(orders.select(F.col("o_orderdate").cast("date").alias("transaction_date"))))


def unpivot_offers(spark, sf_dir):
    return dims.offer_flags(_sales(spark, sf_dir, "transaction_id", *dims.OFFER_PERCENTAGES), "transaction_id")


def fact_sales(spark, sf_dir):
    return with_date_partitions(_fact(spark, sf_dir))


# --- reports ---------------------------------------------------------------------------


def most_selling_products(spark, sf_dir):
    return reports.most_selling_products(_fact(spark, sf_dir, "product_id", "units"), _products(spark, sf_dir))


def most_redeemed_offers(spark, sf_dir):
    return reports.most_redeemed_offers(_fact(spark, sf_dir, "offer_id"), _offers(spark, sf_dir))


def most_redeemed_offers_by_product(spark, sf_dir):
    return reports.most_redeemed_offers_by_product(
        _fact(spark, sf_dir, "product_id", "offer_id"), _products(spark, sf_dir)
    )


def lowest_online_cities(spark, sf_dir):
    fact = _fact(spark, sf_dir, "location_id", "payment_id", "total_price")
    lowest = reports.lowest_online_cities(fact, _locations(spark, sf_dir))
    return lowest.withColumn("total_online_sales", F.round("total_online_sales", 3))


def daily_agent_product_units(spark, sf_dir):
    fact = with_date_partitions(
        _fact(spark, sf_dir, "transaction_date_id", "sales_agent_id", "product_id", "units", day=REPORT_DAY)
    )
    daily = reports.daily_agent_product_units(fact, _products(spark, sf_dir), _agents(spark, sf_dir), REPORT_DAY)
    return daily.orderBy(*reports.daily_report_order())


# --- incremental loads -----------------------------------------------------------------


def incremental_branches(spark, sf_dir):
    batch = _branches(spark, sf_dir)
    return new_rows(batch, batch.where(F.col("establish_date") < F.lit(BRANCHES_BEFORE)), "branch_id")


def incremental_agents(spark, sf_dir):
    batch = _agents(spark, sf_dir)
    return new_rows(batch, batch.where(F.col("hire_date") < F.lit(AGENTS_BEFORE)), "sales_person_id")


def _new_since_stored(spark, sf_dir, dimension, key, columns):
    """New rows of the later sales; of the earlier ones, only the keys are made."""
    before = F.col("transaction_date") < F.lit(STORED_BEFORE)
    batch = dimension(_distinct_sales(spark, sf_dir, *columns, "transaction_date").where(~before))
    stored = _distinct_sales(spark, sf_dir, key, "transaction_date").where(before).select(key).distinct()
    return new_rows(batch, stored, key)


def incremental_customer(spark, sf_dir):
    return _new_since_stored(spark, sf_dir, dims.customer_dim, "customer_id", _CUSTOMER)


def incremental_product(spark, sf_dir):
    return _new_since_stored(spark, sf_dir, dims.product_dim, "product_id", _PRODUCT)


def incremental_location(spark, sf_dir):
    """Locations of the first region are stored."""
    batch = _locations(spark, sf_dir)
    return new_rows(batch, batch.where(F.col("state") == "AFRICA"), "location_id")


def incremental_payment(spark, sf_dir):
    """Payments in branches are stored, online payments are new."""
    sales = _distinct_sales(spark, sf_dir, "is_online", "payment_method")
    return new_rows(dims.payment_dim(sales), dims.payment_dim(sales.where(F.col("is_online") == "no")), "payment_id")


def incremental_offer(spark, sf_dir):
    """Offers up to ten percent are stored."""
    batch = _offers(spark, sf_dir)
    return new_rows(batch, batch.where(F.col("percentage") <= 10), "offer_id")


# --- files and tables ------------------------------------------------------------------


def scan_parquet(spark, sf_dir):
    return sample.sample_table(spark, sf_dir, "orders")


def scan_csv_roundtrip(spark, sf_dir):
    """Sales agents written as a CSV group and read back under the declared schema."""
    folder = work_folder(spark, "csv")
    write_csv(sample.raw_sales_agents(spark, sf_dir), f"{folder}/sales_agents-1.csv")
    return dims.sales_agents_dim(read_group(spark, folder, "sales_agents"))


def _drop(spark, folder, frames: dict[str, DataFrame]) -> str:
    for group, rows in frames.items():
        # What breaks lines is for the landing to find.
        write_csv(rows, f"{folder}/drop/{group}-1.csv", multi_line=True, compression=COMPRESSION)
    return folder


def land_hourly_partitions(spark, sf_dir):
    """Sales dropped as CSV, landed in the partition of the previous hour and read back."""
    folder = work_folder(spark, "landing")
    landing = _drop(spark, f"{folder}/in", {"sales_transactions": sample.raw_sales(spark, sf_dir)})
    land_group(spark, landing, f"{folder}/raw", "sales_transactions", AS_OF, only_last_hour=False)
    return read_raw_zone(spark, f"{folder}/raw", "sales_transactions")


def fact_partitioned_roundtrip(spark, sf_dir):
    folder = work_folder(spark, "fact")
    fact = fact_sales(spark, sf_dir)
    write_fact_folder(fact, folder, hash_days=True)
    return spark.read.schema(fact.schema).parquet(folder)


def b2b_csv_roundtrip(spark, sf_dir):
    folder = report_folder(work_folder(spark, "daily"), REPORT_DAY)
    report = daily_agent_product_units(spark, sf_dir)
    write_csv_report(report, folder, reports.daily_report_order())
    return spark.read.schema(report.schema).csv(folder, header=True)


def _loaded_warehouse(spark, sf_dir, load) -> Warehouse:
    """Two hours of sales through landing and ``load``, then the first one again."""
    folder = work_folder(spark, "warehouse")
    warehouse = Warehouse(spark, f"{folder}/dwh", f"retail_{uuid.uuid4().hex}")
    sales = sample.raw_sales(spark, sf_dir)
    before = F.col("transaction_date") < str(STORED_BEFORE)
    hours = [(AS_OF, sales.where(before)), (AS_OF + HOUR, sales.where(~before))]
    for number, (as_of, rows) in enumerate(hours):
        groups = {
            "sales_transactions": rows,
            "branches": sample.raw_branches(spark, sf_dir),
            "sales_agents": sample.raw_sales_agents(spark, sf_dir),
        }
        landing = _drop(spark, f"{folder}/in-{number}", groups)
        land_hour(spark, landing, f"{folder}/raw", as_of, only_last_hour=False)
        load(spark, f"{folder}/raw", warehouse, as_of)
    load(spark, f"{folder}/raw", warehouse, AS_OF)
    return warehouse


def warehouse_load_fact(spark, sf_dir):
    return _loaded_warehouse(spark, sf_dir, load_hour).table(FACT_TABLE)


def fact_merge_closed_days(spark, sf_dir):
    """Three hours of sales by month, of two batch days: the first day merged and an hour of it loaded again.

    Months instead of days keep the number of partitions small.
    """
    from tillwright.jobs import main  # the jobs import the catalog of plans, this module is one of its readers

    folder, database = work_folder(spark, "warehouse"), f"retail_{uuid.uuid4().hex}"
    warehouse = Warehouse(spark, f"{folder}/dwh", database)
    sales = _sales(spark, sf_dir).withColumn("transaction_date", F.trunc("transaction_date", "month"))
    fact = with_date_partitions(sales_fact(sales))
    third = F.pmod(F.col("product_id"), F.lit(3))
    hours = ["2024050109", "2024050110", "2024050200"]
    for number, hour in enumerate(hours):
        rows = fact.where(third == number)
        warehouse.load_fact(rows if number else rows.limit(7), hour)
    job = ["merge-days", "--warehouse", f"{folder}/dwh", "--database", database, "--before", "2024-05-02"]
    main(job, spark)
    main([*job, "--remove"], spark)
    warehouse.load_fact(fact.where(third == 0), hours[0])
    return warehouse.table(FACT_TABLE)


def warehouse_load_dimensions(spark, sf_dir):
    """Rows and distinct keys of every loaded dimension."""
    warehouse = _loaded_warehouse(spark, sf_dir, load_hour_dimensions)
    counts = [
        warehouse.table(table).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("key_count"))
        .select(F.lit(table).alias("table_name"), "row_count", "key_count")
        for table, key in dims.DIMENSION_KEYS.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def _loaded_dimension(table: str) -> Query:
    """All rows of one loaded dimension; ``date_Dim`` is loaded by every hour and written by the first."""

    def query(spark, sf_dir):
        return _loaded_warehouse(spark, sf_dir, load_hour_dimensions).table(table)

    return query


def scan_csv_reordered_columns(spark, sf_dir):
    """Two files of sales agents, each with its columns in another order, one with an unknown column."""
    folder = work_folder(spark, "csv")
    agents = sample.raw_sales_agents(spark, sf_dir)
    odd = F.col("sales_person_id") % 2 == 1
    write_csv(agents.where(odd).select("hire_date", F.lit("x").alias("unknown"), "name", "sales_person_id"),
              f"{folder}/sales_agents-1.csv")
    write_csv(agents.where(~odd).select("name", "sales_person_id", "hire_date"), f"{folder}/sales_agents-2.csv")
    return dims.sales_agents_dim(read_group(spark, folder, "sales_agents"))


def land_csv_extra_column(spark, sf_dir):
    """A column that is not declared survives the landing."""
    folder = work_folder(spark, "landing")
    agents = sample.raw_sales_agents(spark, sf_dir)
    rows = agents.select(F.upper("name").alias("badge"), *agents.columns)
    target = land_group(
        spark, _drop(spark, f"{folder}/in", {"sales_agents": rows}), f"{folder}/raw", "sales_agents", AS_OF,
        only_last_hour=False,
    )
    return spark.read.schema("badge string, sales_person_id long, name string, hire_date string").csv(target, header=True)


def land_last_hour(spark, sf_dir):
    """Of three drops, the one whose files are from the hour before is landed."""
    folder = work_folder(spark, "landing")
    agents = sample.raw_sales_agents(spark, sf_dir)
    third = F.col("sales_person_id") % 3
    for number, minutes in enumerate((-90, -30, 30)):
        write_csv(agents.where(third == number), f"{folder}/in/drop-{number}/sales_agents-{number}.csv")
        _set_times(spark, f"{folder}/in/drop-{number}/sales_agents-{number}.csv", AS_OF + dt.timedelta(minutes=minutes))
    land_group(spark, f"{folder}/in", f"{folder}/raw", "sales_agents", AS_OF)
    return read_raw_zone(spark, f"{folder}/raw", "sales_agents")


def _set_times(spark: SparkSession, folder: str, at: dt.datetime) -> None:
    """Give the files of a folder a modification time, in the session's time zone."""
    moment = spark.range(1).select(F.unix_millis(F.lit(at.isoformat(" ")).cast("timestamp"))).first()[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        files.setTimes(status.getPath(), moment, -1)


def warehouse_reload_missing_hour(spark, sf_dir):
    """A loaded hour is loaded again from where no raw files are: that fails and the fact stays."""
    folder = work_folder(spark, "warehouse")
    warehouse = Warehouse(spark, f"{folder}/dwh", f"retail_{uuid.uuid4().hex}")
    landing = _drop(spark, f"{folder}/in", {"sales_transactions": sample.raw_sales(spark, sf_dir)})
    land_hour(spark, landing, f"{folder}/raw", AS_OF, only_last_hour=False)
    load_hour(spark, f"{folder}/raw", warehouse, AS_OF)
    try:
        load_hour(spark, f"{folder}/mistyped", warehouse, AS_OF)
    except FileNotFoundError:
        return warehouse.table(FACT_TABLE).drop("batch_hour")
    raise AssertionError("an hour that was not landed was loaded")


def load_partial_hour(spark, sf_dir):
    """After a loaded hour, one of which only the agents were landed: loading it fails and the fact stays."""
    folder = work_folder(spark, "warehouse")
    warehouse = Warehouse(spark, f"{folder}/dwh", f"retail_{uuid.uuid4().hex}")
    landing = _drop(spark, f"{folder}/in", {"sales_transactions": sample.raw_sales(spark, sf_dir)})
    land_hour(spark, landing, f"{folder}/raw", AS_OF, only_last_hour=False)
    load_hour(spark, f"{folder}/raw", warehouse, AS_OF)
    late = _drop(spark, f"{folder}/late", {"sales_agents": sample.raw_sales_agents(spark, sf_dir)})
    land_group(spark, late, f"{folder}/raw", "sales_agents", AS_OF + HOUR, only_last_hour=False)
    try:
        load_hour(spark, f"{folder}/raw", warehouse, AS_OF + HOUR)
    except FileNotFoundError:
        return warehouse.table(FACT_TABLE)
    raise AssertionError("an hour that was landed in part was loaded")


def land_csv_line_breaks(spark, sf_dir):
    """Agents whose names have line breaks, commas and quotes, dropped, landed and loaded by the jobs."""
    from tillwright.jobs import main  # the jobs import the catalog of plans, this module is one of its readers

    folder, database = work_folder(spark, "jobs"), f"retail_{uuid.uuid4().hex}"
    agents = sample.raw_sales_agents(spark, sf_dir)
    broken = F.concat(F.col("name"), F.lit('\nsaid "hi", '), F.col("sales_person_id").cast("string"))
    agents = agents.withColumn("name", F.when(F.col("sales_person_id") % 2 == 0, broken).otherwise(F.col("name")))
    for part in range(2):  # the files of one drop have breaks, those of the other have none
        drop = f"{folder}/in/drop-{part}/sales_agents-{part}.csv"
        write_csv(agents.where(F.col("sales_person_id") % 2 == part), drop, multi_line=True)
        _set_times(spark, drop, AS_OF - dt.timedelta(minutes=30))
    as_of = ["--raw", f"{folder}/raw", "--as-of", AS_OF.isoformat()]
    main(["land", "--landing", f"{folder}/in", *as_of], spark)
    main(["load-hour", "--warehouse", f"{folder}/dwh", "--database", database, *as_of], spark)
    return Warehouse(spark, f"{folder}/dwh", database).table("sales_agents_Dim")


def land_late_files(spark, sf_dir):
    """Of three drops, one older than the hour that no hour has landed is landed with it."""
    folder = work_folder(spark, "landing")
    agents = sample.raw_sales_agents(spark, sf_dir)
    third = F.col("sales_person_id") % 3
    for number, minutes in enumerate((-90, -30, 30)):
        write_csv(agents.where(third == number), f"{folder}/in/drop-{number}/sales_agents-{number}.csv")
        _set_times(spark, f"{folder}/in/drop-{number}/sales_agents-{number}.csv", AS_OF + dt.timedelta(minutes=minutes))
    land_hour(spark, f"{folder}/in", f"{folder}/raw", AS_OF, late=True)
    return read_raw_zone(spark, f"{folder}/raw", "sales_agents")


def incremental_null_keys(spark, sf_dir):
    """Two hours of customers, in both of which every tenth has no key."""
    folder = work_folder(spark, "warehouse")
    warehouse = Warehouse(spark, f"{folder}/dwh", f"retail_{uuid.uuid4().hex}")
    key = F.when(F.col("customer_id") % 10 != 0, F.col("customer_id"))
    sales = clean_sales(sample.raw_sales(spark, sf_dir, [*_CUSTOMER, "transaction_date"], as_set=True))
    sales = sales.withColumn("customer_id", key)
    before = F.col("transaction_date") < F.lit(STORED_BEFORE)
    for hour in (sales.where(before), sales.where(~before)):
        warehouse.load_dimension("customer_Dim", "customer_id", dims.customer_dim(hour))
    return warehouse.table("customer_Dim")


def _small_files(spark, sf_dir, folder) -> DataFrame:
    views = sample.routed_table(spark, sf_dir, "product_view")
    views.repartition(64).write.parquet(folder)
    return views


def compact_preserves_rows(spark, sf_dir):
    folder = work_folder(spark, "compaction")
    views = _small_files(spark, sf_dir, f"{folder}/small")
    compact_folder(spark, f"{folder}/small", f"{folder}/compacted", compare_rows=True)
    return _wall_clock(spark.read.schema(views.schema).parquet(f"{folder}/compacted"))


def compact_new_files_query(spark, sf_dir):
    """A stream's folder, compacted while the stream is between two runs."""
    folder = work_folder(spark, "compaction")
    log = sample.sample_table(spark, sf_dir, "events")
    schema = ROUTED_TABLES["product_view"]

    def start(inbox):
        events = parse.parse_events(event_source(spark, "parquet", path=inbox))
        query = queries.start_file_sink(
            parse.route(events, "product_view"), f"{folder}/live", f"{folder}/checkpoint", every=None
        )
        query.awaitTermination()
        compact_new_files(spark, f"{folder}/live", f"{folder}/compacted", f"{folder}/compaction", schema)
        return query

    feed.replay(log, feed.time_slices(log, "ts", DROPS), sample.event_messages, f"{folder}/inbox", start)
    return _wall_clock(spark.read.schema(schema).parquet(f"{folder}/compacted"))


def _event_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of all routed tables in one frame; a column that a table lacks is NULL."""
    return _wall_clock(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables.values()))


def compact_then_stream(spark, sf_dir):
    """Events are routed and compacted, more are routed; readers of the tables see all of them."""
    folder = work_folder(spark, "compaction")
    log = sample.sample_table(spark, sf_dir, "events")
    database = f"stream_{uuid.uuid4().hex}"
    folders = {table: f"{folder}/out/{table}" for table in ROUTED_TABLES}
    first, *later = feed.time_slices(log, "ts", DROPS)

    def route_drop(drop):
        sample.event_messages(log.where(drop)).write.mode("append").parquet(f"{folder}/inbox")
        messages = event_source(spark, "parquet", path=f"{folder}/inbox")
        queries.await_all(list(queries.start_routes(messages, f"{folder}/out", f"{folder}/c", every=None).values()))

    register_event_tables(spark, {}, database, f"{folder}/db")
    for run, drop in enumerate((first, *later)):
        route_drop(drop)
        if run < len(later):
            for table, schema in ROUTED_TABLES.items():
                compact_run(spark, folders[table], f"{folder}/compacted/{table}", schema, AS_OF)
            register_compacted(spark, folders, f"{folder}/compacted", database)
    for table in ROUTED_TABLES:  # this session listed the files before
        spark.catalog.refreshTable(f"{database}.{table}_files")
    return _event_rows({table: spark.table(f"{database}.{table}") for table in ROUTED_TABLES})


# --- events ----------------------------------------------------------------------------


def _flat_events(events: DataFrame) -> DataFrame:
    names = [name for name in EVENT.names if name != "metadata"]
    metadata = [F.col("metadata")[name].alias(name) for name in parse.METADATA_COLUMNS]
    return _wall_clock(events.select(*names, *metadata))


def stream_parse_events(spark, sf_dir):
    folder = work_folder(spark, "parse")
    events = parse.parse_events(sample.message_stream(spark, sf_dir))
    queries.start_file_sink(events, f"{folder}/out", f"{folder}/checkpoint", every=None).awaitTermination()
    return _flat_events(spark.read.schema(EVENT).parquet(f"{folder}/out"))


def _stream_route(table: str) -> Query:
    def query(spark, sf_dir):
        folder = work_folder(spark, "route")
        rows = parse.route(parse.parse_events(sample.message_stream(spark, sf_dir)), table)
        queries.start_file_sink(rows, f"{folder}/out", f"{folder}/checkpoint", every=None).awaitTermination()
        return _wall_clock(spark.read.schema(ROUTED_TABLES[table]).parquet(f"{folder}/out"))

    return query


def stream_unrouted(spark, sf_dir):
    folder = work_folder(spark, "unrouted")
    rows = parse.unrouted(parse.parse_events(sample.message_stream(spark, sf_dir), keep_value=True))
    queries.start_file_sink(rows, f"{folder}/out", f"{folder}/checkpoint", every=None).awaitTermination()
    return spark.read.schema("value string, eventType string").parquet(f"{folder}/out").select("eventType")


def stream_router(spark, sf_dir):
    """Rows that the single-read router wrote, per table and event type."""
    folder = work_folder(spark, "router")
    queries.start_router(
        sample.message_stream(spark, sf_dir), f"{folder}/out", f"{folder}/checkpoint", every=None
    ).awaitTermination()
    tables = [*ROUTED_TABLES, "unrouted"]
    counts = [
        spark.read.schema("eventType string").parquet(f"{folder}/out/{table}")
        .groupBy("eventType").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(table).alias("table_name"), "eventType", "row_count")
        for table in tables
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def stream_router_events(spark, sf_dir):
    """All rows that the single-read router wrote to the four tables."""
    folder = work_folder(spark, "router")
    queries.start_router(
        sample.message_stream(spark, sf_dir), f"{folder}/out", f"{folder}/checkpoint", every=None
    ).awaitTermination()
    read = spark.read.option("recursiveFileLookup", True)
    return _event_rows({t: read.schema(schema).parquet(f"{folder}/out/{t}") for t, schema in ROUTED_TABLES.items()})


def stream_unrouted_messages(spark, sf_dir):
    """The text of the messages that reach no table."""
    folder = work_folder(spark, "unrouted")
    rows = parse.unrouted(parse.parse_events(sample.message_stream(spark, sf_dir), keep_value=True))
    queries.start_file_sink(rows, f"{folder}/out", f"{folder}/checkpoint", every=None).awaitTermination()
    return spark.read.schema("value string, eventType string").parquet(f"{folder}/out")


def kpi_job_outputs(spark, sf_dir):
    """Events routed by the job for it, KPIs written by theirs, one of them read back."""
    from tillwright.jobs import main  # the jobs import the catalog of plans, this module is one of its readers

    folder = work_folder(spark, "jobs")
    sample.messages(spark, sf_dir).write.parquet(f"{folder}/inbox")
    out = ["--out", f"{folder}/out", "--database", f"stream_{uuid.uuid4().hex}"]
    source = ["--source", "parquet", "--path", f"{folder}/inbox", "--every", "once", "--checkpoint", f"{folder}/c"]
    main(["routes", *source, *out, "--single-read"], spark)
    main(["kpis", *out, "--results", f"{folder}/results"], spark)
    return spark.read.parquet(f"{folder}/results/quantity_per_customer")


#: Places that KPIs in floating point are compared to.
_PLACES = {"total_revenue": 2, "average_order_value": 4}


def _kpi(name: str) -> Query:
    table, kpi = KPIS[name]

    def query(spark, sf_dir):
        rows = kpi(sample.routed_table(spark, sf_dir, table))
        return rows.withColumn(name, F.round(name, _PLACES[name])) if name in _PLACES else rows

    return query


def external_table_kpi(spark, sf_dir):
    """All routes streamed to folders, external tables over them, a KPI by table name."""
    folder = work_folder(spark, "external")
    started = queries.start_routes(
        sample.message_stream(spark, sf_dir), f"{folder}/out", f"{folder}/checkpoints", every=None
    )
    queries.await_all(list(started.values()))
    database = f"stream_{uuid.uuid4().hex}"
    register_event_tables(spark, {t: f"{folder}/out/{t}" for t in ROUTED_TABLES}, database, f"{folder}/db")
    return KPIS["views_per_category"][1](spark.table(f"{database}.product_view"))


# --- windowed counts -------------------------------------------------------------------


def batch_event_counts(spark, sf_dir):
    events = parse.parse_events(sample.messages(spark, sf_dir), fields=window_counts.EVENT_COUNT_FIELDS)
    return _wall_clock(window_counts.flat_window(window_counts.event_counts(events), "eventType"))


def _replay(spark, sf_dir, drops, start_on) -> str:
    """Deliver the log in drops to a stateful query; returns the folder it serves from."""
    folder = work_folder(spark, "windows")
    session = stateful_session(spark, STATE_PARTITIONS)
    log = sample.sample_table(spark, sf_dir, "events")

    def start(inbox):
        return start_on(event_source(session, "parquet", path=inbox), f"{folder}/out", f"{folder}/checkpoint")

    feed.replay(log, drops(log), sample.event_messages, f"{folder}/inbox", start)
    return f"{folder}/out"


_COUNTS = "window_start timestamp, window_end timestamp, {key} string, count long"
_VERSIONS = _COUNTS + ", batch_id long"


def _in_time_order(log):
    return feed.time_slices(log, "ts", DROPS)


def stream_event_counts(spark, sf_dir):
    def start(messages, out, checkpoint):
        return queries.start_closed_event_counts(messages, out, checkpoint, every=None)

    out = _replay(spark, sf_dir, _in_time_order, start)
    return _wall_clock(spark.read.schema(_COUNTS.format(key="eventType")).parquet(out))


def _updated_counts(spark, sf_dir, drops) -> DataFrame:
    def start(messages, out, checkpoint):
        return queries.start_event_counts(messages, "parquet", {"path": out}, checkpoint, every=None)

    versions = spark.read.schema(_VERSIONS.format(key="eventType")).parquet(_replay(spark, sf_dir, drops, start))
    return _wall_clock(serving.latest_versions(versions, ["window_start", "window_end", "eventType"]))


def stream_event_counts_update(spark, sf_dir):
    return _updated_counts(spark, sf_dir, _in_time_order)


def stream_event_counts_retired(spark, sf_dir):
    """Update mode into a store in buckets, cut to the newest versions twice; the second time finds none to cut."""
    def start(messages, out, checkpoint):
        return queries.start_event_counts(messages, "parquet", {"path": out}, checkpoint, every=None, buckets=True)

    out, schema = _replay(spark, sf_dir, _in_time_order, start), _VERSIONS.format(key="eventType")
    keys = ["window_start", "window_end", "eventType"]
    serving.retire_buckets(spark, out, keys, schema)
    if removed := serving.retire_buckets(spark, out, keys, schema):
        raise ValueError(f"{removed} files of buckets at rest were removed")
    # Every key is there once, so no newest version has to be looked for.
    return _wall_clock(spark.read.schema(schema).parquet(out).drop(serving.BATCH, serving.BUCKET))


def stream_late_data(spark, sf_dir):
    """Clicks arrive after everything else: those in closed windows are dropped."""
    clicked = F.col("event_type") == "click"
    return _updated_counts(spark, sf_dir, lambda log: [~clicked, clicked])


def stream_top_products(spark, sf_dir):
    def start(messages, out, checkpoint):
        return queries.start_top_products(messages, "parquet", {"path": out}, checkpoint, every=None)

    versions = spark.read.schema(_VERSIONS.format(key="productId")).parquet(
        _replay(spark, sf_dir, _in_time_order, start)
    )
    return _wall_clock(serving.latest_batch(versions))


def stream_top_products_latest_window(spark, sf_dir):
    def start(messages, out, checkpoint):
        return queries.start_closed_product_counts(messages, out, checkpoint, every=None)

    out = _replay(spark, sf_dir, _in_time_order, start)
    counts = spark.read.schema(_COUNTS.format(key="productId")).parquet(out)
    return _wall_clock(window_counts.top_of_latest_window(counts))


def stream_top_products_per_window(spark, sf_dir):
    """The ranking of every closed window, made inside the stream."""

    def start(messages, out, checkpoint):
        return queries.start_closed_top_products(messages, out, checkpoint, every=None)

    out = _replay(spark, sf_dir, _in_time_order, start)
    schema = "window_start timestamp, window_end timestamp, rank int, productId string, count long"
    return _wall_clock(spark.read.schema(schema).parquet(out))


def _with_late(spark, sf_dir) -> str:
    """Clicks arrive after everything else; returns the folder of the counts and of what was late."""

    def start(messages, out, checkpoint):
        return late_rows.start_event_counts_with_late(messages, out, checkpoint, every=None)

    clicked = F.col("event_type") == "click"
    return _replay(spark, sf_dir, lambda log: [~clicked, clicked], start)


def stream_late_side_table(spark, sf_dir):
    """The messages that came too late for their window."""
    late = late_rows.read_late(spark, _with_late(spark, sf_dir))
    return _wall_clock(late.select("value", "eventType", "timestamp", "window_end"))


def stream_counts_beside_late(spark, sf_dir):
    """Counts of what was in time; with the side table they add up to all events."""
    out = _with_late(spark, sf_dir)
    batches = late_rows.read_batches(spark, out).agg(F.sum("read"), F.sum(F.col("counted") + F.col("late") + F.col("timeless")))
    read, told = batches.first()
    if read != told or read != sample.sample_table(spark, sf_dir, "events").count():
        raise AssertionError("rows were lost")
    return _wall_clock(late_rows.counts(late_rows.read_increments(spark, out)))


def dimension_key_violations(spark, sf_dir):
    """Customers with several rows, of whom some have several versions."""
    return key_violations(_changed_customers(spark, sf_dir), "customer_id")


def _changed_customers(spark, sf_dir) -> DataFrame:
    """Every fifth customer once more under another name, and every tenth twice the same."""
    customers = _customers(spark, sf_dir)
    renamed = customers.where(F.col("customer_id") % 5 == 0).withColumn("customer_fname", F.lit("Renamed"))
    again = customers.where(F.col("customer_id") % 10 == 0)
    return customers.unionByName(renamed).unionByName(again)


def dimension_unique_keys(spark, sf_dir):
    """The same customers for a report: one row per key, the others in quarantine."""
    folder = work_folder(spark, "quarantine")
    kept = unique_keys(_changed_customers(spark, sf_dir), "customer_id", "customer_Dim", folder)
    beyond = spark.read.schema(kept.schema).parquet(f"{folder}/customer_Dim")
    return kept.withColumn("kept", F.lit(True)).unionByName(beyond.withColumn("kept", F.lit(False)))


QUERIES: dict[str, Query] = {
    "clean_sales": clean_sales_query,
    "dim_customer": _customers,
    "dim_location": _locations,
    "dim_payment": _payments,
    "dim_product": _products,
    "dim_offer": _offers,
    "dim_date": dim_date,
    "dim_branches": _branches,
    "dim_sales_agents": _agents,
    "unpivot_offers": unpivot_offers,
    "fact_sales": fact_sales,
    "most_selling_products": most_selling_products,
    "most_redeemed_offers": most_redeemed_offers,
    "most_redeemed_offers_by_product": most_redeemed_offers_by_product,
    "lowest_online_cities": lowest_online_cities,
    "daily_agent_product_units": daily_agent_product_units,
    "incremental_branches": incremental_branches,
    "incremental_agents": incremental_agents,
    "incremental_customer": incremental_customer,
    "incremental_location": incremental_location,
    "incremental_payment": incremental_payment,
    "incremental_product": incremental_product,
    "incremental_offer": incremental_offer,
    "scan_parquet": scan_parquet,
    "scan_csv_roundtrip": scan_csv_roundtrip,
    "land_hourly_partitions": land_hourly_partitions,
    "fact_partitioned_roundtrip": fact_partitioned_roundtrip,
    "b2b_csv_roundtrip": b2b_csv_roundtrip,
    "warehouse_load_fact": warehouse_load_fact,
    "fact_merge_closed_days": fact_merge_closed_days,
    "warehouse_load_dimensions": warehouse_load_dimensions,
    **{f"warehouse_{table}": _loaded_dimension(table) for table in [*dims.DIMENSION_KEYS, DATE_TABLE]},
    "scan_csv_reordered_columns": scan_csv_reordered_columns,
    "land_csv_extra_column": land_csv_extra_column,
    "land_last_hour": land_last_hour,
    "land_late_files": land_late_files,
    "land_csv_line_breaks": land_csv_line_breaks,
    "load_partial_hour": load_partial_hour,
    "warehouse_reload_missing_hour": warehouse_reload_missing_hour,
    "incremental_null_keys": incremental_null_keys,
    "compact_then_stream": compact_then_stream,
    "compact_preserves_rows": compact_preserves_rows,
    "compact_new_files": compact_new_files_query,
    "stream_parse_events": stream_parse_events,
    **{f"stream_route_{table}": _stream_route(table) for table in ROUTED_TABLES},
    "stream_unrouted": stream_unrouted,
    "stream_router": stream_router,
    "stream_router_events": stream_router_events,
    "stream_unrouted_messages": stream_unrouted_messages,
    "kpi_job_outputs": kpi_job_outputs,
    **{f"kpi_{name}": _kpi(name) for name in KPIS},
    "external_table_kpi": external_table_kpi,
    "batch_event_counts": batch_event_counts,
    "stream_event_counts": stream_event_counts,
    "stream_event_counts_update": stream_event_counts_update,
    "stream_event_counts_retired": stream_event_counts_retired,
    "stream_late_data": stream_late_data,
    "stream_top_products": stream_top_products,
    "stream_top_products_latest_window": stream_top_products_latest_window,
    "stream_top_products_per_window": stream_top_products_per_window,
    "stream_late_side_table": stream_late_side_table,
    "stream_counts_beside_late": stream_counts_beside_late,
    "dimension_key_violations": dimension_key_violations,
    "dimension_unique_keys": dimension_unique_keys,
}

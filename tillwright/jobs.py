"""The jobs by name, for ``spark-submit tillwright/jobs.py <job> ...``.

Paths, times and connections are arguments; secrets come from the environment variables
``TILLWRIGHT_KAFKA_SECRET`` and ``TILLWRIGHT_JDBC_SECRET``.  Master and resources are left
to ``spark-submit``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tillwright.operators.dimensions import CALENDAR_END, CALENDAR_START, DIMENSION_KEYS  # noqa: E402
from tillwright.operators.key_checks import unique_keys  # noqa: E402
from tillwright.plans import reports  # noqa: E402
from tillwright.plans.hourly_load import load_hour  # noqa: E402
from tillwright.plans.kpis import KPIS  # noqa: E402
from tillwright.schemas import ROUTED_TABLES  # noqa: E402
from tillwright.session import build_session, stateful_session  # noqa: E402
from tillwright.sinks.compaction import compact_run, retire_originals  # noqa: E402
from tillwright.sinks.csv_report import report_folder, write_csv_report  # noqa: E402
from tillwright.sinks.warehouse import (  # noqa: E402
    FACT_TABLE,
    RETAIL,
    STREAM,
    Warehouse,
    register_compacted,
    register_event_tables,
)
from tillwright.sources.events import event_source, kafka_options  # noqa: E402
from tillwright.sources.raw_zone import HOUR, land_hour, unlanded_files  # noqa: E402
from tillwright.streaming import late_rows, queries, serving  # noqa: E402
from tillwright.streaming.serving import jdbc_options  # noqa: E402
from tillwright.streaming.window_counts import top_of_latest_window  # noqa: E402

#: What the counting jobs serve: the window, and the key of each job.
SERVED = "window_start timestamp, window_end timestamp"
SERVED_WINDOW = ["window_start", "window_end"]
SERVED_KEYS = {"event-counts": "eventType", "top-products": "productId"}

#: How raw files are read: as each file shows, all as a whole, or all line by line.
MULTI_LINE = {"find": None, "yes": True, "no": False}

#: Marketing reports and the dimension each looks names up in.
MARKETING = {
    "most_selling_products": (reports.most_selling_products, "product_Dim"),
    "most_redeemed_offers": (reports.most_redeemed_offers, "offer_Dim"),
    "most_redeemed_offers_by_product": (reports.most_redeemed_offers_by_product, "product_Dim"),
    "lowest_online_cities": (reports.lowest_online_cities, "location_Dim"),
}


def land(spark: SparkSession, args) -> None:
    """Land the hour; files that are older and were never landed are counted, or landed with ``--late``."""
    for group, folder in land_hour(
        spark, args.landing, args.raw, args.as_of, replace=args.replace, late=args.late, multi_line=MULTI_LINE[args.multi_line]
    ).items():
        left = unlanded_files(spark, args.landing, args.raw, group, args.as_of - HOUR).count()
        print(group, folder, f"{left} older files in no hour" if left else "")


def load(spark: SparkSession, args) -> None:
    warehouse = Warehouse(spark, args.warehouse, args.database)
    load_hour(
        spark, args.raw, warehouse, args.as_of, args.one_per_key, args.rejects, args.allow_empty, args.hash_days,
        (args.calendar_from, args.calendar_to),
    )


def merge_days(spark: SparkSession, args) -> None:
    """Merge the hours of closed days of the fact, or with ``--remove`` drop what earlier merges replaced."""
    warehouse = Warehouse(spark, args.warehouse, args.database)
    if args.remove:
        print(warehouse.remove_merged(), "folders removed")
    else:
        print(*warehouse.merge_closed_days(args.before), "merged")


def marketing(spark: SparkSession, args) -> None:
    warehouse = Warehouse(spark, args.warehouse, args.database)
    fact = warehouse.table(FACT_TABLE)
    for name, (report, dimension) in MARKETING.items():
        _publish(report(fact, _names(warehouse, dimension, args)), args.out, name)


def _names(warehouse: Warehouse, dimension: str, args) -> DataFrame:
    """A dimension for a report, with its keys checked if that is asked for."""
    rows = warehouse.table(dimension)
    if args.keys == "any":
        return rows
    if args.keys == "quarantine" and not args.quarantine:
        raise SystemExit("--keys quarantine needs --quarantine")
    return unique_keys(rows, DIMENSION_KEYS[dimension], dimension, args.quarantine)


def _publish(rows: DataFrame, folder: str, name: str) -> None:
    """All rows of a result as parquet; only where they are is printed."""
    rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    print(f"{folder}/{name}")


def daily(spark: SparkSession, args) -> None:
    warehouse = Warehouse(spark, args.warehouse, args.database)
    report = reports.daily_agent_product_units(
        warehouse.table(FACT_TABLE), _names(warehouse, "product_Dim", args), _names(warehouse, "sales_agents_Dim", args),
        args.day,
    )
    folder = report_folder(args.out, args.day)
    print(folder, write_csv_report(report, folder, reports.daily_report_order(), args.files), "rows")


def _messages(spark: SparkSession, args) -> DataFrame:
    if args.source != "kafka":
        return event_source(spark, args.source, path=args.path)
    secret = os.environ.get("TILLWRIGHT_KAFKA_SECRET")
    return event_source(
        spark, "kafka", **kafka_options(args.servers, args.topic, args.user, secret, args.starting, args.most_per_trigger)
    )


def _every(args) -> str | None:
    return None if args.every == "once" else args.every


def routes(spark: SparkSession, args) -> None:
    """Four queries, or with ``--single-read`` one that reads and parses the source once and keeps all rejects."""
    messages = _messages(spark, args)
    if args.single_read:
        started = [queries.start_router(messages, args.out, args.checkpoint, _every(args))]
    else:
        started = queries.start_routes(messages, args.out, args.checkpoint, _every(args), args.with_unrouted).values()
    register_event_tables(spark, {t: f"{args.out}/{t}" for t in ROUTED_TABLES}, args.database)
    queries.await_all(list(started))


def kpis(spark: SparkSession, args) -> None:
    register_event_tables(spark, {t: f"{args.out}/{t}" for t in ROUTED_TABLES}, args.database)
    for name, (table, kpi) in KPIS.items():
        _publish(kpi(spark.table(f"{args.database}.{table}")), args.results, name)


def _served(spark: SparkSession, args, start, start_closed) -> None:
    messages = _messages(stateful_session(spark, args.state_partitions), args)
    if args.closed:
        queries.await_all([start_closed(messages, args.folder, args.checkpoint, _every(args))])
        return
    tasks = None
    if args.folder:
        kind, options = "parquet", {"path": args.folder}
    else:
        secret = os.environ["TILLWRIGHT_JDBC_SECRET"]
        kind, options = "jdbc", jdbc_options(args.jdbc_url, args.jdbc_table, args.jdbc_driver, args.jdbc_user, secret)
        tasks = args.connections
    queries.await_all([start(messages, kind, options, args.checkpoint, _every(args), tasks)])


def event_counts(spark: SparkSession, args) -> None:
    if args.buckets and (args.closed or not args.folder):
        raise SystemExit("--buckets is for versions in a --folder")
    start = partial(queries.start_event_counts, buckets=args.buckets)
    _served(spark, args, start, queries.start_closed_event_counts)


def counts_with_late(spark: SparkSession, args) -> None:
    """Counts as increments below ``--folder``, and messages that came too late in a side table there."""
    messages = _messages(spark, args)
    queries.await_all([late_rows.start_event_counts_with_late(messages, args.folder, args.checkpoint, _every(args))])


def window_rankings(spark: SparkSession, args) -> None:
    messages = _messages(stateful_session(spark, args.state_partitions), args)
    queries.await_all([queries.start_closed_top_products(messages, args.folder, args.checkpoint, _every(args))])


def top_products(spark: SparkSession, args) -> None:
    _served(spark, args, queries.start_top_products, queries.start_closed_product_counts)


def latest_window(spark: SparkSession, args) -> None:
    """The ranking of the newest window that ``top-products --closed`` has written."""
    counts = spark.read.schema(f"{SERVED}, productId string, count long").parquet(args.folder)
    _publish(top_of_latest_window(counts), args.out, "latest_window")


def versions_view(spark: SparkSession, args) -> None:
    """The statement that makes the view of newest versions in the database that holds them."""
    key = SERVED_KEYS[args.of]
    print(serving.latest_versions_view(args.view, args.jdbc_table, [*SERVED_WINDOW, f'"{key}"'], ["count"]))


def retire_versions(spark: SparkSession, args) -> None:
    """Cut a parquet store down to its newest versions (event-counts) or newest batch (top-products)."""
    key = SERVED_KEYS[args.of]
    survivors = serving.newest_batch
    if args.of == "event-counts":
        survivors = serving.newest_versions_with_batch([*SERVED_WINDOW, key])
    schema = f"{SERVED}, {key} string, count long, batch_id long"
    if args.buckets:
        if args.of != "event-counts":
            raise SystemExit("--buckets is for event-counts; a batch of top-products replaces all before it")
        print(serving.retire_buckets(spark, args.folder, [*SERVED_WINDOW, key], schema), "files removed")
        return
    print(serving.retire_versions(spark, args.folder, survivors, schema), "files removed")


def compact(spark: SparkSession, args) -> None:
    """Compact what the streams wrote since the last run, and let readers see it and what comes after."""
    for table, schema in ROUTED_TABLES.items():
        print(table, compact_run(spark, f"{args.out}/{table}", f"{args.target}/{table}", schema, args.as_of), "files")
    register_compacted(spark, {t: f"{args.out}/{t}" for t in ROUTED_TABLES}, args.target, args.database)


def retire(spark: SparkSession, args) -> None:
    """Remove the originals of runs that are older than the grace period."""
    before = args.as_of - dt.timedelta(hours=args.hours)
    for table in ROUTED_TABLES:
        print(table, retire_originals(spark, f"{args.target}/{table}", before), "files removed")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillwright", description=__doc__)
    parser.add_argument("--no-hive", action="store_true", help="do without a lasting catalog")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, run, *arguments):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for argument in arguments:
            argument(sub)

    def arg(name, **how):
        return lambda sub: sub.add_argument(name, **how)

    def source(trigger, starting):
        def add(sub):
            sub.add_argument("--source", choices=["kafka", "parquet", "text"], default="kafka")
            for name in ("--path", "--servers", "--topic", "--user"):
                sub.add_argument(name)
            sub.add_argument("--starting", choices=["earliest", "latest"], default=starting,
                             help="where a new checkpoint starts")
            sub.add_argument("--most-per-trigger", type=int)
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--every", default=trigger, help="pause between batches, or 'once'")

        return add

    def store(sub):
        sub.add_argument("--folder", help="serve versions from a parquet folder instead of a database")
        sub.add_argument("--closed", action="store_true",
                         help="write each window once to --folder, when the watermark closes it; state is bounded")
        sub.add_argument("--connections", type=int, default=8, help="tasks that write to the database at once")
        for name in ("--jdbc-url", "--jdbc-table", "--jdbc-driver", "--jdbc-user"):
            sub.add_argument(name)
        sub.add_argument("--state-partitions", type=int, required=True,
                         help="fixed for as long as the checkpoint lives; choose for the largest load expected")

    as_of = arg("--as-of", type=dt.datetime.fromisoformat, required=True, help="works on the hour before")
    raw, warehouse = arg("--raw", required=True), arg("--warehouse", required=True)
    retail, stream = arg("--database", default=RETAIL), arg("--database", default=STREAM)
    out = arg("--out", required=True)

    def flag(name, help):
        return arg(name, action="store_true", help=help)

    def date(name, default=None):
        return arg(name, type=dt.date.fromisoformat, default=default, required=default is None)

    keys = [
        arg("--keys", choices=["any", "unique", "quarantine"], default="any",
            help="dimensions with a key twice: as they are, raise, or one row per key and the others to --quarantine"),
        arg("--quarantine"),
    ]
    folder, of = arg("--folder", required=True), arg("--of", choices=list(SERVED_KEYS), required=True)
    buckets = flag("--buckets", "versions of event-counts lie in a folder for each day of windows")

    job("land", land, arg("--landing", required=True), raw, as_of, flag("--replace", "also with fewer files than before"),
        flag("--late", "older files too that are in no hour"),
        arg("--multi-line", choices=list(MULTI_LINE), default="find", help="whether quoted values go on over line breaks"))
    job(
        "load-hour", load, raw, warehouse, retail, as_of, flag("--one-per-key", "of a new key, the smallest row"),
        arg("--rejects"), flag("--allow-empty", "an hour without sales may replace one with sales"),
        flag("--hash-days", "many small days: each to one of the shuffle partitions"),
        date("--calendar-from", CALENDAR_START), date("--calendar-to", CALENDAR_END),
    )
    job("merge-days", merge_days, warehouse, retail, date("--before"),
        flag("--remove", "what earlier merges replaced, when no reader uses it any more"))
    job("marketing", marketing, warehouse, retail, out, *keys)
    job("daily-report", daily, warehouse, retail, date("--day"), out, *keys, arg("--files", choices=["one", "many"], default="one"))
    job(
        "routes", routes, source(queries.ROUTE_TRIGGER, "earliest"), out, stream,
        flag("--with-unrouted", "also what reaches no table"), flag("--single-read", "read and parse the source once"),
    )
    job("kpis", kpis, out, stream, arg("--results", required=True))
    job("event-counts", event_counts, source(queries.EVENT_COUNT_TRIGGER, "latest"), store, buckets)
    job("top-products", top_products, source(queries.TOP_PRODUCTS_TRIGGER, "latest"), store)
    job("counts-with-late", counts_with_late, source(queries.EVENT_COUNT_TRIGGER, "latest"), folder)
    job("window-rankings", window_rankings, source(queries.TOP_PRODUCTS_TRIGGER, "latest"), folder,
        arg("--state-partitions", type=int, required=True))
    job("latest-window", latest_window, folder, out)
    job("versions-view", versions_view, of, arg("--view", required=True), arg("--jdbc-table", required=True))
    job("retire-versions", retire_versions, of, folder, buckets)
    now = arg("--as-of", type=dt.datetime.fromisoformat, required=True, help="time that runs are noted with")
    job("compact", compact, out, arg("--target", required=True), stream, now)
    job("retire", retire, arg("--target", required=True), now, arg("--hours", type=float, required=True))
    return parser


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(arguments)
    own = spark is None
    spark = spark or build_session(f"tillwright {args.job}", hive=not args.no_hive)
    try:
        args.run(spark, args)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main()

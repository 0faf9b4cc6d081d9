"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts.  Rows go
to the ``noop`` sink, so everything is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwright.registry import QUERIES  # noqa: E402
from tillwright.session import build_session  # noqa: E402

HEADLINE = [
    "clean_sales",
    "fact_sales",
    "dim_customer",
    "dim_product",
    "dim_location",
    "dim_offer",
    "most_selling_products",
    "most_redeemed_offers",
    "most_redeemed_offers_by_product",
    "lowest_online_cities",
    "daily_agent_product_units",
    "incremental_customer",
    "incremental_product",
    "kpi_views_per_category",
    "kpi_unique_customers_per_category",
    "kpi_quantity_per_customer",
    "kpi_total_revenue",
    "kpi_average_order_value",
    "batch_event_counts",
    "land_hourly_partitions",
    "compact_preserves_rows",
    "stream_parse_events",
    "stream_route_product_view",
    "stream_router",
    "stream_event_counts_update",
    "stream_top_products",
    "fact_partitioned_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {}
    for name in wanted:
        seconds(name)
        times[name] = round(statistics.median(seconds(name) for _ in range(runs)), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

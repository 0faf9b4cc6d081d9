"""Starting, awaiting and stopping the streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.schemas import ROUTED_TABLES
from tillwright.streaming.parse import is_unrouted, parse_events, route, unrouted
from tillwright.streaming.serving import day_bucket, version_writer
from tillwright.streaming.window_counts import (
    EVENT_COUNT_FIELDS,
    PRODUCT_COUNT_FIELDS,
    event_counts,
    flat_window,
    product_view_counts,
    top_products,
    top_products_per_window,
)

# Pause between micro-batches of each kind of query.
ROUTE_TRIGGER = "10 seconds"
EVENT_COUNT_TRIGGER = "3 minutes"
TOP_PRODUCTS_TRIGGER = "30 seconds"


def _trigger(every: str | None) -> dict:
    """``every`` is a pause, or None to work through what is there and end."""
    return {"processingTime": every} if every else {"availableNow": True}


def start_file_sink(rows: DataFrame, folder: str, checkpoint: str, every: str | None = ROUTE_TRIGGER) -> StreamingQuery:
    """Append to a parquet folder, each row once."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def start_batch_sink(
    rows: DataFrame, write: Callable[[DataFrame, int], None], mode: str, checkpoint: str, every: str | None
) -> StreamingQuery:
    """Hand every micro-batch to ``write`` in output mode ``append``, ``update`` or ``complete``."""
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def start_routes(
    messages: DataFrame, root: str, checkpoints: str, every: str | None = ROUTE_TRIGGER, with_unrouted: bool = False
) -> dict[str, StreamingQuery]:
    """One query per routed table, each with its own checkpoint; they fail and restart apart."""
    events = parse_events(messages)
    frames = {table: route(events, table) for table in ROUTED_TABLES}
    if with_unrouted:
        frames["unrouted"] = unrouted(parse_events(messages, keep_value=True))
    return {
        table: start_file_sink(frame, f"{root}/{table}", f"{checkpoints}/{table}", every)
        for table, frame in frames.items()
    }


def start_router(messages: DataFrame, root: str, checkpoint: str, every: str | None = ROUTE_TRIGGER) -> StreamingQuery:
    """All routes from one read of the source.

    A micro-batch is parsed once, kept parsed, and written to every table.  Its files lie
    under ``batch_id=<n>`` of the table, which a replay after a failure replaces.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch, keep_value=True)
        text = F.when(is_unrouted(), F.col("value"))
        events = parsed.withColumn("value", text).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            frames = {table: route(events, table) for table in ROUTED_TABLES} | {"unrouted": unrouted(events)}
            for table, frame in frames.items():
                frame.write.mode("overwrite").parquet(f"{root}/{table}/batch_id={batch_id}")
        finally:
            events.unpersist()

    return start_batch_sink(messages, write, "append", checkpoint, every)


def start_event_counts(
    messages: DataFrame, kind: str, options: dict[str, str], checkpoint: str, every: str | None = EVENT_COUNT_TRIGGER,
    tasks: int | None = None, buckets: bool = False,
) -> StreamingQuery:
    """Counts per window and event type in update mode, appended as versions to a ``kind`` store.

    With ``buckets`` a file store has a folder for each day of windows.
    """
    counts = event_counts(parse_events(messages, fields=EVENT_COUNT_FIELDS))
    bucket = day_bucket() if buckets else None
    write = version_writer(lambda batch: flat_window(batch, "eventType"), kind, options, tasks, bucket)
    return start_batch_sink(counts, write, "update", checkpoint, every)


def start_top_products(
    messages: DataFrame, kind: str, options: dict[str, str], checkpoint: str, every: str | None = TOP_PRODUCTS_TRIGGER,
    tasks: int | None = None,
) -> StreamingQuery:
    """Most viewed products over all windows in complete mode, appended as versions to a ``kind`` store."""
    top = top_products(parse_events(messages, fields=PRODUCT_COUNT_FIELDS))
    write = version_writer(lambda batch: flat_window(batch, "productId"), kind, options, tasks)
    return start_batch_sink(top, write, "complete", checkpoint, every)


def start_closed_event_counts(
    messages: DataFrame, folder: str, checkpoint: str, every: str | None = EVENT_COUNT_TRIGGER
) -> StreamingQuery:
    """Counts per window and event type, written once, when the watermark closes the window."""
    counts = event_counts(parse_events(messages, fields=EVENT_COUNT_FIELDS))
    return start_file_sink(flat_window(counts, "eventType"), folder, checkpoint, every)


def start_closed_product_counts(
    messages: DataFrame, folder: str, checkpoint: str, every: str | None = TOP_PRODUCTS_TRIGGER
) -> StreamingQuery:
    """Views per window and product, written once, when the watermark closes the window."""
    counts = product_view_counts(parse_events(messages, fields=PRODUCT_COUNT_FIELDS))
    return start_file_sink(flat_window(counts, "productId"), folder, checkpoint, every)


def start_closed_top_products(
    messages: DataFrame, folder: str, checkpoint: str, every: str | None = TOP_PRODUCTS_TRIGGER
) -> StreamingQuery:
    """The ranking of each window, written once, when the watermark closes the window; no batch job follows."""
    return start_file_sink(
        top_products_per_window(parse_events(messages, fields=PRODUCT_COUNT_FIELDS)), folder, checkpoint, every
    )


def await_all(queries: list[StreamingQuery], poll_seconds: float = 0.2) -> None:
    """Wait until all queries ended; the first failure stops the others and is raised.

    The queries are looked at in turn, so a failure of any is seen while others run, and
    failures of queries that are not in the list are not mistaken for theirs.
    """
    try:
        running = list(queries)
        while running:
            running = [query for query in running if not query.awaitTermination(poll_seconds)]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()

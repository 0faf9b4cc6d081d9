"""Counts per tumbling window, with a watermark; the same on batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Windows, watermarks and length of the ranking.
EVENT_COUNT_WINDOW, EVENT_COUNT_LATENESS = "10 minutes", "2 minutes"
TOP_PRODUCTS_WINDOW, TOP_PRODUCTS_LATENESS = "30 minutes", "30 minutes"
TOP_PRODUCTS = 5

#: Event fields that the counts read.
EVENT_COUNT_FIELDS = ("eventType", "timestamp")
PRODUCT_COUNT_FIELDS = ("eventType", "productId", "timestamp")


def count_by_window(events: DataFrame, key: str, window: str, lateness: str) -> DataFrame:
    """Rows per window and key.  Rows without a time are in no window.

    Rows are combined per task before the shuffle, so a hot key costs one row per task
    and window.
    """
    return (
        events.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", window), key)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def flat_window(counts: DataFrame, key: str) -> DataFrame:
    """The served columns: the window as its two bounds."""
    return counts.select(
        F.col("window")["start"].alias("window_start"), F.col("window")["end"].alias("window_end"), key, "count"
    )


def event_counts(events: DataFrame) -> DataFrame:
    return count_by_window(events, "eventType", EVENT_COUNT_WINDOW, EVENT_COUNT_LATENESS)


def product_view_counts(events: DataFrame) -> DataFrame:
    views = events.where(F.col("eventType") == "productView").select("productId", "timestamp")
    return count_by_window(views, "productId", TOP_PRODUCTS_WINDOW, TOP_PRODUCTS_LATENESS)


def top_products(events: DataFrame, rows: int = TOP_PRODUCTS) -> DataFrame:
    """Highest counts over every window seen so far, for output mode ``complete``.

    That mode keeps the state of all windows.  :func:`top_of_latest_window` over
    append-mode counts ranks the newest window with state bounded by the watermark.
    """
    return product_view_counts(events).orderBy(F.desc("count"), "window.start", "productId").limit(rows)


#: Groups that the products of a window are ranked in first.
RANKING_PARTS = 64


def top_products_per_window(events: DataFrame, rows: int = TOP_PRODUCTS, parts: int = RANKING_PARTS) -> DataFrame:
    """The most viewed products of every closed window, ranked inside the stream.

    Stateful aggregations in a chain, for append mode: counts per window and product, the best of each of
    ``parts`` groups of a window's products, and the best of those.  Each drops a window's state when the watermark
    closes it, and no group holds all products of a window.  Ties go by product; views without product count
    as one.
    """
    counts = product_view_counts(events)
    best_first = F.struct((-F.col("count")).alias("minus"), "productId")
    ranked = lambda lists: F.slice(F.sort_array(lists), 1, rows)
    part = F.pmod(F.xxhash64("productId"), F.lit(parts)).alias("part")
    in_parts = counts.groupBy(_window_again(), part).agg(ranked(F.collect_list(best_first)).alias("best"))
    whole = in_parts.groupBy(_window_again()).agg(ranked(F.flatten(F.collect_list("best"))).alias("best"))
    return whole.select(
        F.col("window")["start"].alias("window_start"), F.col("window")["end"].alias("window_end"), F.posexplode("best")
    ).select(
        "window_start", "window_end", (F.col("pos") + 1).alias("rank"), F.col("col.productId").alias("productId"),
        (-F.col("col.minus")).alias("count"),
    )


def _window_again():
    """The window that an earlier aggregation counted by, as a window of the next one."""
    return F.window(F.window_time("window"), TOP_PRODUCTS_WINDOW)


def top_of_latest_window(counts: DataFrame, rows: int = TOP_PRODUCTS) -> DataFrame:
    """Highest counts of the newest closed window in served append-mode counts."""
    newest = counts.agg(F.max("window_end").alias("window_end"))
    return (
        counts.join(F.broadcast(newest), "window_end", "left_semi")
        .orderBy(F.desc("count"), "productId")
        .limit(rows)
    )

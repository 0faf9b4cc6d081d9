"""Windowed counts that keep what comes too late in a side table.

The built-in aggregation drops late rows without a trace.  Here every micro-batch is counted by itself and
appended as increments, and rows whose window was closed before the batch began go to the side table.  The
watermark is as Spark's: the latest time of all batches before, less the allowed lateness.  It is measured on each
batch and kept with it.  Whatever a batch writes lies under its number, so a replay after a
failure replaces it, and rows counted, late and without time always add up to the rows read.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.streaming.parse import parse_events
from tillwright.streaming.queries import EVENT_COUNT_TRIGGER, start_batch_sink
from tillwright.streaming.window_counts import EVENT_COUNT_LATENESS, EVENT_COUNT_WINDOW

#: Folders of a query's output: increments, late messages, and what is known of each batch.
INCREMENTS, LATE, BATCHES = "increments", "late", "batches"
INCREMENT_ROWS = "window_start timestamp, window_end timestamp, eventType string, count long, batch_id long"
LATE_ROWS = "value string, eventType string, timestamp timestamp, window_end timestamp, watermark timestamp, batch_id long"
BATCH_ROWS = "batch_id long, watermark timestamp, latest timestamp, read long, counted long, late long, timeless long"


def read_increments(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INCREMENT_ROWS).parquet(f"{root}/{INCREMENTS}")


def read_late(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(LATE_ROWS).parquet(f"{root}/{LATE}")


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(BATCH_ROWS).parquet(f"{root}/{BATCHES}")


def counts(increments: DataFrame) -> DataFrame:
    """Rows per window and event type, over all batches."""
    return increments.groupBy("window_start", "window_end", "eventType").agg(F.sum("count").alias("count"))


def _watermark(spark: SparkSession, root: str, batch_id: int, lateness: str) -> int | None:
    """The latest time that batches before this one have seen, less the lateness, in microseconds."""
    if not batch_id:
        return None
    seen = read_batches(spark, root).where(F.col("batch_id") < batch_id)
    return seen.agg(F.unix_micros(F.max("latest") - F.expr(f"INTERVAL {lateness}"))).first()[0]


def start_event_counts_with_late(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = EVENT_COUNT_TRIGGER,
    window: str = EVENT_COUNT_WINDOW,
    lateness: str = EVENT_COUNT_LATENESS,
) -> StreamingQuery:
    """Counts per window and event type as increments below ``root``, late messages whole in a side table.

    Rows are combined per task before the shuffle, so a hot type costs one row per task and window.  No state is
    kept between batches but a row per batch; :func:`counts` adds the increments up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        watermark = _watermark(spark, root, batch_id, lateness)
        bound = F.timestamp_micros(F.lit(watermark).cast("long"))
        events = parse_events(batch, keep_value=True).select("value", "eventType", "timestamp")
        # The window of a row without time is NULL; the function would drop the row.
        at = F.coalesce("timestamp", F.lit(0).cast("timestamp"))
        events = events.select("*", F.window(at, window).alias("window"))
        late = F.col("timestamp").isNotNull() & (F.col("window.end") <= bound)
        events = events.withColumn("late", F.coalesce(late, F.lit(False))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            found = events.agg(
                F.unix_micros(F.max("timestamp")).alias("latest"), F.count(F.lit(1)).alias("read"),
                F.count_if("late").alias("late"), F.count_if(F.col("timestamp").isNull()).alias("timeless"),
            ).first()
            in_time = events.where(~F.col("late") & F.col("timestamp").isNotNull())
            counted = in_time.groupBy("window", "eventType").agg(F.count(F.lit(1)).alias("count"))
            # batch_id is a partition of the folder, said in the schema of its readers.
            counted.select("window.start", "window.end", "eventType", "count").toDF(
                "window_start", "window_end", "eventType", "count"
            ).write.mode("overwrite").parquet(f"{root}/{INCREMENTS}/batch_id={batch_id}")
            events.where("late").select(
                "value", "eventType", "timestamp", F.col("window.end").alias("window_end"), bound.alias("watermark")
            ).write.mode("overwrite").parquet(f"{root}/{LATE}/batch_id={batch_id}")
        finally:
            events.unpersist()
        row = (
            watermark, found["latest"], found["read"], found["read"] - found["late"] - found["timeless"], found["late"],
            found["timeless"],
        )
        names = ["watermark", "latest", "read", "counted", "late", "timeless"]
        made = spark.createDataFrame([row], ", ".join(f"{name} long" for name in names))
        made = made.withColumns({name: F.timestamp_micros(name) for name in names[:2]})
        made.write.mode("overwrite").parquet(f"{root}/{BATCHES}/batch_id={batch_id}")

    return start_batch_sink(messages, write, "append", checkpoint, every)

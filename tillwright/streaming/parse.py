"""Messages to typed events, and events to the tables they belong in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.schemas import EVENT, ROUTED_TABLES

# The event type each routed table holds.
EVENT_TYPE_OF_TABLE = {
    "product_view": "productView",
    "add_to_cart": "addToCart",
    "purchase": "purchase",
    "recommendation_click": "recommendationClick",
}

# Columns taken out of an event's metadata.
METADATA_COLUMNS = ("category", "source")


def parse_events(messages: DataFrame, keep_value: bool = False, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Message text to the event superset.

    A field of the wrong type becomes NULL alone, unknown fields are ignored, text that
    is no JSON object gives a row of NULLs.  ``keep_value`` keeps the text beside them.
    ``fields`` are those of the superset that are needed, if not all.

    The parsed struct is spread by a generator.  A filter on one of its fields stays
    above that; behind a plain projection it would be pushed below and every message be
    parsed twice.
    """
    text = messages.select(F.col("value").cast("string").alias("value"))
    kept = ["value"] if keep_value else []
    schema = EVENT if fields is None else StructType([EVENT[name] for name in fields])
    return text.select(*kept, F.inline(F.array(F.from_json("value", schema))))


def route(events: DataFrame, table: str) -> DataFrame:
    """Events of one routed table, with that table's columns."""
    columns = [
        F.col("metadata")[field.name].alias(field.name) if field.name in METADATA_COLUMNS else F.col(field.name)
        for field in ROUTED_TABLES[table].fields
    ]
    return events.where(F.col("eventType") == EVENT_TYPE_OF_TABLE[table]).select(*columns)


def is_unrouted() -> Column:
    """Whether an event reaches no table: unknown event type, none, or no JSON at all."""
    return ~F.coalesce(F.col("eventType").isin(*EVENT_TYPE_OF_TABLE.values()), F.lit(False))


def unrouted(events: DataFrame) -> DataFrame:
    """Text and type of the events that reach no table, from events parsed with their value."""
    return events.where(is_unrouted()).select("value", "eventType")

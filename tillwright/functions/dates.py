"""Dates and the keys derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The format of date keys, and where year, month and day sit in it.
DATE_ID_FORMAT = "yyyyMMdd"
DATE_ID_PARTS = {"year": (1, 4), "month": (5, 2), "day": (7, 2)}


def try_date(text: Column) -> Column:
    """Text to date; anything that is not a date becomes NULL, also under ANSI."""
    return text.try_cast("date")


def date_id(date: Column) -> Column:
    return F.date_format(date, DATE_ID_FORMAT)


def date_parts(key: Column) -> dict[str, Column]:
    """Zero-padded text parts of a date key, the partition columns of the fact."""
    return {part: F.substring(key, start, length) for part, (start, length) in DATE_ID_PARTS.items()}

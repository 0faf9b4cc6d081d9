"""One hour of raw files into the warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.operators.cleaning import clean_sales, date_rejects
from tillwright.operators.dimensions import (
    CALENDAR_END,
    CALENDAR_START,
    DIMENSION_KEYS,
    branches_dim,
    calendar,
    date_dim,
    dimension_parts,
    dimensions_of_parts,
    sales_agents_dim,
)
from tillwright.operators.fact import sales_fact
from tillwright.sinks.files import delete
from tillwright.sinks.warehouse import DATE_TABLE, Warehouse
from tillwright.sources.raw_zone import HOUR, hour_path, missing_groups, read_group

# Fixed value: folder of the warehouse in which a load keeps the parts of its dimensions until it has written them.
PARTS = "_parts"


def load_hour(
    spark: SparkSession,
    raw_root: str,
    warehouse: Warehouse,
    as_of: dt.datetime,
    one_per_key: bool = False,
    rejects_folder: str | None = None,
    allow_empty: bool = False,
    hash_days: bool = False,
    days: tuple[dt.date, dt.date] = (CALENDAR_START, CALENDAR_END),
) -> None:
    """Load the hour before ``as_of``; running it again changes nothing.

    Dimensions go first, so a reader finds the keys of every fact row it sees.  An hour of which not all groups were
    landed raises before anything is loaded; one that was landed without sales is a batch without rows, which replaces one
    with rows only if ``allow_empty`` is given.  ``days`` are the ends of the calendar.
    """
    _need_landed(spark, raw_root, as_of)
    batch_hour = f"{as_of - HOUR:%Y%m%d%H}"
    raw = read_group(spark, hour_path(raw_root, as_of), "sales_transactions")
    sales = clean_sales(raw)
    rejects = f"{rejects_folder.rstrip('/')}" if rejects_folder else None
    _load_dimensions(spark, raw_root, warehouse, as_of, sales, one_per_key, days, rejects)
    warehouse.load_fact(sales_fact(sales), batch_hour, hash_days, allow_empty)
    if rejects:
        _write_rejects(date_rejects(raw, "transaction_date"), f"{rejects}/sales_transactions/batch_hour={batch_hour}")


def load_hour_dimensions(
    spark: SparkSession, raw_root: str, warehouse: Warehouse, as_of: dt.datetime, one_per_key: bool = False
) -> None:
    """The dimensions of the hour before ``as_of`` alone."""
    _need_landed(spark, raw_root, as_of)
    sales = clean_sales(read_group(spark, hour_path(raw_root, as_of), "sales_transactions"))
    _load_dimensions(spark, raw_root, warehouse, as_of, sales, one_per_key)


def _need_landed(spark: SparkSession, raw_root: str, as_of: dt.datetime) -> None:
    hour = hour_path(raw_root, as_of)
    if missing := missing_groups(spark, hour):
        raise FileNotFoundError(f"{hour} was not landed: no {', '.join(missing)}")


@contextmanager
def _kept(spark: SparkSession, parts: DataFrame, folder: str) -> Iterator[DataFrame]:
    """What the five dimensions of the sales are made of, written to files once for all of them.

    The sales themselves are not kept: writing them down costs more than the second reading that the fact takes.
    Files, because a plan that names a persisted frame of grouping sets twice, as an append does, only finds one of the
    two in the cache and makes the other from all sales again.  AQE sizes the files; a persisted frame would
    stay in all shuffle partitions, and each write of a dimension would shuffle from all of them to all.
    """
    parts.write.mode("overwrite").parquet(folder)
    try:
        yield spark.read.schema(parts.schema).parquet(folder)
    finally:
        delete(spark, folder)


def _load_dimensions(
    spark: SparkSession,
    raw_root: str,
    warehouse: Warehouse,
    as_of: dt.datetime,
    sales: DataFrame,
    one_per_key: bool,
    days: tuple[dt.date, dt.date] = (CALENDAR_START, CALENDAR_END),
    rejects: str | None = None,
) -> None:
    """All dimensions of an hour; with ``rejects``, rows without a key are kept there."""
    folder = hour_path(raw_root, as_of)
    batch_hour = f"batch_hour={as_of - HOUR:%Y%m%d%H}"
    with _kept(spark, dimension_parts(sales), f"{warehouse.folder(PARTS)}/{batch_hour}") as parts:
        dimensions = {
            "branches_Dim": branches_dim(read_group(spark, folder, "branches")),
            "sales_agents_Dim": sales_agents_dim(read_group(spark, folder, "sales_agents")),
            **dimensions_of_parts(parts),
        }
        for table, rows in dimensions.items():
            key = DIMENSION_KEYS[table]
            warehouse.load_dimension(table, key, rows, one_per_key)
            if rejects:
                _write_rejects(rows.where(F.col(key).isNull()), f"{rejects}/{table}/{batch_hour}")
    warehouse.load_static(DATE_TABLE, date_dim(calendar(spark, *days)))


def _write_rejects(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").parquet(folder)

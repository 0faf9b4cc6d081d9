"""Keys that a dimension holds more than once, and a dimension without them.

Reports join sums per key to names; a key with two versions would count its sums twice.  Loads keep the first version of a key
against later batches, but rows of one key within a batch all stay unless asked otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """A dimension holds keys with several versions."""


def key_violations(rows: DataFrame, key: str) -> DataFrame:
    """``key, row_count, version_count`` of each key with more than one row; a missing key is one of them.

    One hash aggregation, combined per task.
    """
    others = [F.col(name) for name in rows.columns if name != key]
    return (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct(F.struct(*others)).alias("version_count"))
        .where((F.col("row_count") > 1) | F.col(key).isNull())
    )


def split_versions(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """One row per key, the smallest by the other columns, and all rows beyond: other versions, copies, rows without key.

    The smallest is found by an aggregation that combines per task.  Copies are told apart by their number, so
    both parts together are the rows there were.
    """
    names = rows.columns
    others = [name for name in names if name != key]
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"))
    smallest = counted.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("kept"))
    kept = smallest.select(key, "kept.*").select(*names)
    joined = counted.join(smallest.withColumnRenamed(key, "kept_key"), F.col(key) == F.col("kept_key"), "left")
    is_kept = F.coalesce(F.struct(*others).eqNullSafe(F.col("kept")) & F.col("kept_key").isNotNull(), F.lit(False))
    left = joined.withColumn("copies", F.col("copies") - is_kept.cast("long")).where("copies > 0")
    beyond = left.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*names)
    return kept, beyond


def unique_keys(rows: DataFrame, key: str, name: str, quarantine: str | None = None) -> DataFrame:
    """``rows`` for a report: as they are if every key is there once.

    Otherwise with ``quarantine`` one row per key, and the rows left out are written to that folder by ``name``; without
    it this raises.
    """
    violations = key_violations(rows, key)
    if violations.isEmpty():
        return rows
    if quarantine is None:
        example = violations.orderBy(F.desc("row_count"), key).first()
        raise DuplicateKeys(f"{name}: {key} {example[key]!r} has {example['row_count']} rows")
    kept, beyond = split_versions(rows, key)
    beyond.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/{name}")
    return kept

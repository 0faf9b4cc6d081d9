"""Merging the hours of closed days of the fact into few files.

An hourly load writes a file per batch hour and sales day.  When a batch day is over, its hours are rewritten to a second
table, partitioned by batch day instead of hour, in which the hour is a plain column.  A manifest says which hours are
read from there, and from which merge.  The fact's name becomes a view: merged rows that the manifest names, and
the hours it doesn't name.  So a merge counts by one change of the view, and a broken one is done again.

An hour can still be loaded again: it is written where it always was and leaves the manifest, which takes its merged rows out of
sight.  The next merge rewrites that day.  Originals are removed in a step of its own, when no reader uses them any more.
"""

from __future__ import annotations

import datetime as dt
from typing import TYPE_CHECKING

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillwright.operators.fact import DATE_PARTITIONS
from tillwright.sinks.files import children, delete

if TYPE_CHECKING:
    from tillwright.sinks.warehouse import Warehouse

# What is added to the fact's name for its parts, and columns of the merged table.
HOURS, MERGED, MANIFEST = "_hours", "_merged", "_merges"
MERGE, BATCH_DAY, BATCH_HOUR = "merge", "batch_day", "batch_hour"
MERGED_PARTITIONS = [MERGE, BATCH_DAY, *DATE_PARTITIONS]
MANIFEST_ROWS = "batch_hour string, merge string"


def newest_manifest(warehouse: Warehouse, fact: str) -> int:
    """Number of the newest whole manifest; 0 where no day was merged."""
    folder = warehouse.folder(fact + MANIFEST)
    versions = [int(name.removeprefix("v=")) for name in children(warehouse.spark, folder) if name.startswith("v=")]
    whole = [v for v in versions if "_SUCCESS" in children(warehouse.spark, f"{folder}/v={v}")]
    return max(whole, default=0)


def read_manifest(warehouse: Warehouse, fact: str) -> DataFrame:
    version = newest_manifest(warehouse, fact)
    if not version:
        return warehouse.spark.createDataFrame([], MANIFEST_ROWS)
    return warehouse.spark.read.schema(MANIFEST_ROWS).parquet(f"{warehouse.folder(fact + MANIFEST)}/v={version}")


def _commit(warehouse: Warehouse, fact: str, manifest: DataFrame) -> None:
    """Write the next manifest, then let readers see it.  It has a row per merged hour."""
    version = newest_manifest(warehouse, fact) + 1
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{warehouse.folder(fact + MANIFEST)}/v={version}")
    declare_view(warehouse, fact)


def declare_view(warehouse: Warehouse, fact: str) -> None:
    """The fact as a view over merged days and hours, by the newest manifest."""
    spark = warehouse.spark
    if spark.catalog.tableExists(warehouse.name(fact)):
        if spark.catalog.getTable(warehouse.name(fact)).tableType != "VIEW":
            spark.sql(f"DROP TABLE {warehouse.name(fact)}")  # external: the files stay
    columns = ", ".join(f"`{name}`" for name in spark.table(warehouse.name(fact + HOURS)).columns)
    manifest = f"parquet.`{warehouse.folder(fact + MANIFEST)}/v={newest_manifest(warehouse, fact)}`"
    spark.sql(
        f"CREATE OR REPLACE VIEW {warehouse.name(fact)} AS "
        f"SELECT {columns} FROM {warehouse.name(fact + MERGED)} AS m LEFT SEMI JOIN {manifest} AS f "
        f"ON m.{BATCH_HOUR} = f.{BATCH_HOUR} AND m.{MERGE} = f.{MERGE} UNION ALL "
        f"SELECT {columns} FROM {warehouse.name(fact + HOURS)} AS h LEFT ANTI JOIN {manifest} AS f "
        f"ON h.{BATCH_HOUR} = f.{BATCH_HOUR}"
    )


def declare_parts(warehouse: Warehouse, fact: str, partitions: list[str]) -> None:
    """Tables over the hours and over the merged days, where the catalog has none."""
    spark = warehouse.spark
    known = [name for name in (fact + HOURS, fact + MERGED) if spark.catalog.tableExists(warehouse.name(name))]
    if len(known) == 2:
        return
    try:
        columns = spark.read.parquet(warehouse.folder(fact)).schema
    except AnalysisException as error:  # every hour was merged and removed
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        columns = spark.read.parquet(warehouse.folder(fact + MERGED)).schema
    plain = [f for f in columns.fields if f.name not in {*partitions, *MERGED_PARTITIONS}]
    for name, folder, extra, parts in (
        (fact + HOURS, fact, "", partitions), (fact + MERGED, fact + MERGED, f", {BATCH_HOUR} string", MERGED_PARTITIONS)
    ):
        if name in known:
            continue
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain)
        listed += extra + "".join(f", `{part}` string" for part in parts)
        spark.sql(
            f"CREATE TABLE {warehouse.name(name)} ({listed}) USING parquet PARTITIONED BY ({', '.join(parts)}) "
            f"LOCATION '{warehouse.folder(folder)}'"
        )
        if children(spark, warehouse.folder(folder)):
            spark.catalog.recoverPartitions(warehouse.name(name))


def merge_closed_days(warehouse: Warehouse, fact: str, partitions: list[str], before: dt.date) -> list[str]:
    """Merge the hours of all batch days before a date that are not merged yet; returns those days.

    Days are merged as a whole, so one of which an hour was loaded again is rewritten.  Rows are counted in the pass that
    writes them and compared with the footers of what was written; a difference raises and readers go on with
    what they had.
    """
    spark = warehouse.spark
    declare_parts(warehouse, fact, partitions)
    manifest = read_manifest(warehouse, fact)
    day = F.substring(BATCH_HOUR, 1, 8)
    there = spark.sql(f"SHOW PARTITIONS {warehouse.name(fact + HOURS)}")
    hours = there.select(F.regexp_extract("partition", f"{BATCH_HOUR}=([^/]*)", 1).alias(BATCH_HOUR)).distinct()
    fresh = hours.join(manifest, BATCH_HOUR, "left_anti").where(day < f"{before:%Y%m%d}")
    days = sorted(row[0] for row in fresh.select(day).distinct().collect())
    if not days:
        return []
    if not newest_manifest(warehouse, fact):
        _commit(warehouse, fact, manifest)  # the view, with nothing merged
    merge = f"{newest_manifest(warehouse, fact):06}"
    rows = spark.table(warehouse.name(fact)).where(day.isin(days)).withColumn(BATCH_DAY, day)
    counted = None
    if not rows.isEmpty():  # a write that adaptive execution finds empty measures nothing
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    plain = [name for name in rows.columns if name not in MERGED_PARTITIONS and name != BATCH_HOUR]
    gathered = rows.hint("rebalance", *[F.col(name) for name in (BATCH_DAY, *DATE_PARTITIONS)])
    gathered = gathered.select(*plain, BATCH_HOUR, F.lit(merge).alias(MERGE), BATCH_DAY, *DATE_PARTITIONS)
    target = f"{warehouse.folder(fact + MERGED)}/{MERGE}={merge}"
    delete(spark, target)  # what a merge that broke left
    gathered.write.mode("append").insertInto(warehouse.name(fact + MERGED))
    written = spark.table(warehouse.name(fact + MERGED)).where(F.col(MERGE) == merge)
    expected = counted.get["rows"] if counted else 0
    if (found := written.count()) != expected:
        raise RuntimeError(f"{target} holds {found} of {expected} rows; readers still use the hours")
    # Hours without rows are noted too, as they have partitions no more.
    moved = written.select(BATCH_HOUR).union(fresh.where(day.isin(days)).select(BATCH_HOUR)).distinct()
    rest = manifest.where(~F.substring(BATCH_HOUR, 1, 8).isin(days))
    _commit(warehouse, fact, rest.union(moved.select(BATCH_HOUR, F.lit(merge))))
    return days


def forget_hour(warehouse: Warehouse, fact: str, batch_hour: str) -> None:
    """Read an hour from where it was loaded to, not from a merge."""
    manifest = read_manifest(warehouse, fact)
    if not manifest.where(F.col(BATCH_HOUR) == batch_hour).isEmpty():
        _commit(warehouse, fact, manifest.where(F.col(BATCH_HOUR) != batch_hour))


def remove_merged(warehouse: Warehouse, fact: str) -> int:
    """Remove the originals of merged hours and merges that no hour is read from; returns the folders removed."""
    spark, removed = warehouse.spark, 0
    manifest = read_manifest(warehouse, fact)
    merged = {row[0] for row in manifest.select(BATCH_HOUR).distinct().collect()}  # an hour each, no files
    used = {row[0] for row in manifest.select(MERGE).distinct().collect()}
    for name, folder, column, goes in (
        (fact + HOURS, fact, BATCH_HOUR, lambda value: value in merged),
        (fact + MERGED, fact + MERGED, MERGE, lambda value: value not in used),
    ):
        for child in children(spark, warehouse.folder(folder)):
            key, _, value = child.partition("=")
            if key == column and goes(value):
                spark.sql(f"ALTER TABLE {warehouse.name(name)} DROP IF EXISTS PARTITION ({column} = '{value}')")
                removed += delete(spark, f"{warehouse.folder(folder)}/{child}")
        spark.catalog.refreshTable(warehouse.name(name))
    return removed

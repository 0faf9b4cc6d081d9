"""Catalog tables of the warehouse and how each is loaded."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.operators.fact import DATE_PARTITIONS, with_date_partitions
from tillwright.operators.incremental import first_per_key, new_rows_for_small_batch
from tillwright.schemas import ROUTED_TABLES
from tillwright.sinks import fact_merge
from tillwright.sinks.compaction import view_compacted

# Names of the databases and of the tables that are not keyed dimensions.
RETAIL = "retail"
STREAM = "stream"
FACT_TABLE = "sales_transactions_Fact"
DATE_TABLE = "date_Dim"

#: Column that says which hourly batch a fact row came with; the outermost partition.
BATCH_HOUR = "batch_hour"
FACT_PARTITIONS = [BATCH_HOUR, *DATE_PARTITIONS]

#: Bounds a file where Spark's byte-based sizing does not apply.
RECORDS_PER_FILE = 20_000_000


class Warehouse:
    """A database of external parquet tables below one folder."""

    def __init__(self, spark: SparkSession, root: str, database: str = RETAIL):
        self.spark, self.root, self.database = spark, root.rstrip("/"), database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)} LOCATION '{self.root}'")

    def name(self, table: str) -> str:
        return f"{_name(self.database)}.{_name(table)}"

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise LookupError(f"{self.name(table)} was not loaded yet")
        return self.spark.table(self.name(table))

    def exists(self, table: str) -> bool:
        """Whether a table was loaded.

        The catalog is asked first.  Where it does not know the table, as in a session
        without a lasting one, the folder is: rows found there are registered again, so
        that a lost entry is never taken for a first load.
        """
        if self.spark.catalog.tableExists(self.name(table)):
            return True
        if table == FACT_TABLE and fact_merge.newest_manifest(self, table):
            fact_merge.declare_parts(self, table, FACT_PARTITIONS)
            fact_merge.declare_view(self, table)
            return True
        try:
            found = self.spark.read.parquet(self.folder(table)).schema
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        partitions = FACT_PARTITIONS if table == FACT_TABLE else []
        self._declare(table, found, partitions)
        if partitions:
            self.spark.catalog.recoverPartitions(self.name(table))
        return True

    # -- loads

    def load_static(self, table: str, rows: DataFrame) -> bool:
        """Write a table once; later runs leave it alone."""
        if self.exists(table):
            return False
        self._create(table, rows)
        return True

    def load_dimension(self, table: str, key: str, rows: DataFrame, one_per_key: bool = False) -> None:
        """First load writes the rows, later ones append those with a new key.

        Rows without a key are stored by neither.
        """
        rows = rows.where(F.col(key).isNotNull())
        if not self.exists(table):
            self._create(table, first_per_key(rows, key) if one_per_key else rows)
            return
        batch = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh = new_rows_for_small_batch(batch, self.table(table), key, one_per_key)
            fresh.hint("rebalance").write.mode("append").insertInto(self.name(table))
        finally:
            batch.unpersist()

    def load_fact(
        self, fact: DataFrame, batch_hour: str, hash_days: bool = False, allow_empty: bool = False
    ) -> None:
        """Replace one hourly batch of the fact.

        The batch hour is the outermost partition, so loading an hour again overwrites
        what that hour wrote before and nothing else.  Filters on the text columns year, month
        and day prune as usual; a ``fact`` without them gets them from its date key, once it was shuffled.  A batch without rows only
        replaces one with rows if ``allow_empty`` is given.  ``hash_days`` is said at
        :func:`by_day`.
        """
        if not re.fullmatch(r"\w+", batch_hour):
            raise ValueError(f"not a batch hour: {batch_hour!r}")
        if not self.exists(FACT_TABLE):
            self._declare(FACT_TABLE, _with_parts(fact).schema, FACT_PARTITIONS)
        stored = self.table(FACT_TABLE).where(F.col(BATCH_HOUR) == batch_hour)
        if not allow_empty and fact.isEmpty() and not stored.isEmpty():
            raise ValueError(f"hour {batch_hour} has rows and the new batch has none")
        merging = self.spark.catalog.tableExists(self.name(FACT_TABLE + fact_merge.HOURS))
        target = self.name(FACT_TABLE + fact_merge.HOURS if merging else FACT_TABLE)
        names = [name for name in fact.columns if name not in FACT_PARTITIONS]
        batch = _with_parts(by_day(fact, hash_days)).select(*names, *DATE_PARTITIONS)
        # Days that the hour no longer has are removed too, whatever mode the session is in.
        with _setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "static"):
            self.spark.sql(
                f"INSERT OVERWRITE TABLE {target} "
                f"PARTITION ({BATCH_HOUR} = '{batch_hour}', {', '.join(DATE_PARTITIONS)}) SELECT * FROM {{batch}}",
                batch=batch,
            )
        if merging:
            fact_merge.forget_hour(self, FACT_TABLE, batch_hour)

    def merge_closed_days(self, before: dt.date) -> list[str]:
        """Merge the hours of batch days before a date; said at :mod:`fact_merge`."""
        return fact_merge.merge_closed_days(self, FACT_TABLE, FACT_PARTITIONS, before) if self.exists(FACT_TABLE) else []

    def remove_merged(self) -> int:
        """Remove files that merges have replaced."""
        return fact_merge.remove_merged(self, FACT_TABLE) if self.exists(FACT_TABLE) else 0

    def _create(self, table: str, rows: DataFrame) -> None:
        """Write a table that has no rows yet; what a broken first load left is replaced.

        Files are sized by AQE from the bytes shuffled, instead of written by one task.
        """
        (
            rows.hint("rebalance")
            .write.format("parquet")
            .mode("overwrite")
            .option("path", self.folder(table))
            .option("maxRecordsPerFile", RECORDS_PER_FILE)
            .saveAsTable(self.name(table))
        )

    def _declare(self, table: str, schema: StructType, partitions: list[str]) -> None:
        """External table over a folder."""
        columns = [f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields if f.name not in partitions]
        columns += [f"{_name(part)} string" for part in partitions]
        partitioned = f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else ""
        self.spark.sql(
            f"CREATE TABLE {self.name(table)} ({', '.join(columns)}) USING parquet {partitioned}"
            f"LOCATION '{self.folder(table)}'"
        )


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for as long as one write takes."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _with_parts(fact: DataFrame) -> DataFrame:
    """A fact with its date partitions, made from its date key where it has none yet."""
    return fact if set(DATE_PARTITIONS) <= set(fact.columns) else with_date_partitions(fact)


def by_day(fact: DataFrame, hash_days: bool = False) -> DataFrame:
    """Gather the rows of a day, so that a day is few files.

    The partitioning is left to a rebalance, which merges small days and splits a large
    one by the bytes it measured.  ``hash_days`` deals days to all shuffle partitions instead,
    each to one task: for many days of which none is large, where a rebalance would merge their few
    bytes into one task that then writes the files of all.
    """
    columns = [F.col(part) for part in DATE_PARTITIONS if part in fact.columns] or [F.col("transaction_date_id")]
    if not hash_days:
        return fact.hint("rebalance", *columns)
    return fact.repartition(int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def write_fact_folder(fact: DataFrame, folder: str, hash_days: bool = False) -> None:
    """The fact as a plain parquet folder partitioned by year, month and day."""
    (
        by_day(fact, hash_days)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy(*DATE_PARTITIONS)
        .parquet(folder)
    )


def register_event_tables(
    spark: SparkSession, folders: dict[str, str], database: str = STREAM, root: str | None = None, suffix: str = ""
) -> None:
    """External tables over the folders that the event streams write."""
    location = f" LOCATION '{root}'" if root else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}{location}")
    for table, folder in folders.items():
        columns = ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in ROUTED_TABLES[table].fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_name(database)}.{_name(table + suffix)} ({columns}) "
            # A router's folders lie below; originals of compacted files are removed in time.
            f"USING parquet OPTIONS ('recursiveFileLookup' 'true', 'ignoreMissingFiles' 'true') LOCATION '{folder}'"
        )


def register_compacted(spark: SparkSession, folders: dict[str, str], target: str, database: str = STREAM) -> None:
    """Let readers of the event tables see compacted files and what the streams added since.

    The table over a stream's folder goes on as ``<table>_files``; its old name becomes a view.  As with
    any table of files, a session that has read it lists new files after ``REFRESH TABLE <table>_files``.
    """
    for table, folder in folders.items():
        name = f"{_name(database)}.{_name(table)}"
        register_event_tables(spark, {table: folder}, database, suffix="_files")
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
        files = f"{_name(database)}.{_name(table + '_files')}"
        view_compacted(spark, name, files, f"{target}/{table}", ROUTED_TABLES[table])


def point_table_at(spark: SparkSession, table: str, folder: str) -> None:
    """Let readers of a table see another folder, in one catalog change."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def _name(identifier: str) -> str:
    return "`" + identifier.replace("`", "``") + "`"

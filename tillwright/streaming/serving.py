"""Keyed serving on stores that can only append.

Update and complete mode emit a key again whenever it changes.  Every micro-batch is
appended with its number, and readers take the newest version of a key.  A batch that is
replayed after a failure writes the same rows under the same number, so whatever was
written twice reads as once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.sinks.files import delete

BATCH = "batch_id"
#: Folders of a store whose versions are retired bucket by bucket.
BUCKET = "bucket"
#: The bucket of keys that have none.
NO_BUCKET = -1
DAY_SECONDS = 86_400


def day_bucket(time: str = "window_start") -> Column:
    """The day of a window as a number, the same in every time zone.

    Windows of days behind the watermark never change again, so their buckets come to rest.
    """
    return F.floor(F.unix_timestamp(time) / DAY_SECONDS).cast("long")


def jdbc_options(url: str, table: str, driver: str, user: str, secret: str) -> dict[str, str]:
    """Writer options of a database table, created by the first batch.

    How many tasks write at once is left to :func:`version_writer`: the writer's own bound merges
    the tasks of whatever was computed before, the state of all keys included.
    """
    return {
        "url": url,
        "dbtable": table,
        "driver": driver,
        "user": user,
        "password": secret,
    }


def version_writer(
    shape: Callable[[DataFrame], DataFrame], kind: str, options: dict[str, str], tasks: int | None = None,
    bucket: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback appending shaped batches to ``jdbc``, ``parquet`` or another format.

    ``tasks`` bounds how many write at once, by a shuffle of the counted rows.  With ``bucket``, a whole
    number that follows from the key, a file store gets a folder for each; see :func:`retire_buckets`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        versions = shape(batch).withColumn(BATCH, F.lit(batch_id).cast("long"))
        if tasks:
            versions = versions.repartition(tasks)
        if bucket is None:
            versions.write.format(kind).mode("append").options(**options).save()
        else:
            # A batch has few buckets; AQE merges small ones and splits one that holds most rows.
            dealt = versions.withColumn(BUCKET, F.coalesce(bucket, F.lit(NO_BUCKET))).hint("rebalance", BUCKET)
            dealt.write.format(kind).mode("append").options(**options).partitionBy(BUCKET).save()

    return write


def latest_versions(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of every key, for update mode.

    One hash aggregation, combined per task.  Rows of a key in one batch are copies of
    each other, so taking the columns one by one cannot mix versions.
    """
    values = [name for name in versions.columns if name not in [*keys, BATCH, BUCKET]]
    return versions.groupBy(*keys).agg(*[F.max_by(name, BATCH).alias(name) for name in values])


def latest_versions_view(view: str, table: str, keys: list[str], values: list[str]) -> str:
    """:func:`latest_versions` as a view for the database that holds the versions."""
    listed, grouped = ", ".join([*keys, *values]), ", ".join(keys)
    return (
        f"CREATE VIEW {view} AS SELECT {listed} FROM ("
        f"SELECT {listed}, row_number() OVER (PARTITION BY {grouped} ORDER BY {BATCH} DESC) AS age FROM {table}"
        f") AS versions WHERE age = 1"
    )


def retire_versions(spark: SparkSession, folder: str, survivors: Callable[[DataFrame], DataFrame], schema: str) -> int:
    """Cut a parquet store down to the versions that readers still take; returns the files removed.

    ``survivors`` gives the rows to keep, with their batch number.  They are appended before the files
    they come from are removed; readers take the newest version once, so they may see both.  Files that
    a running query adds meanwhile are not touched.
    """
    read = spark.read.schema(schema)
    files = [unquote(path) for path in read.parquet(folder).inputFiles()]
    if not files:
        return 0
    survivors(read.parquet(*files)).write.mode("append").parquet(folder)
    return sum(delete(spark, file) for file in files)


def retire_buckets(spark: SparkSession, folder: str, keys: list[str], schema: str) -> int:
    """:func:`retire_versions` for update mode and a store in buckets; leaves buckets at rest as they are.

    A file is of one batch or of one retirement, and both have a key once, so a bucket of one file needs
    nothing and is not read.  Of the others, those in which a key has several rows are written anew, each
    by about as many tasks as its bytes need; only their keys are read to tell.  ``schema`` leaves the
    bucket out.  Only names of files come to the driver, and those of a resting bucket are few.
    """
    read = spark.read.schema(f"{schema}, {BUCKET} long").option("basePath", folder)
    files = defaultdict(list)
    for path in read.parquet(folder).inputFiles():
        name = unquote(path)
        files[int(name.rsplit("/", 2)[1].removeprefix(f"{BUCKET}="))].append(name)
    several = [name for names in files.values() if len(names) > 1 for name in names]
    if not several:
        return 0
    # A key's rows are in its bucket, so that is no more than another column of the group.
    repeated = read.parquet(*several).groupBy(BUCKET, *keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    changed = [name for row in repeated.select(BUCKET).distinct().toLocalIterator() for name in files[row[BUCKET]]]
    if not changed:
        return 0
    newest = newest_versions_with_batch([BUCKET, *keys])(read.parquet(*changed))
    newest.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(folder)
    return sum(delete(spark, file) for file in changed)


def newest_versions_with_batch(keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Survivors of update mode: the newest version of every key."""

    def survivors(versions: DataFrame) -> DataFrame:
        values = [name for name in versions.columns if name not in [*keys, BATCH]]
        newest = [F.max_by(name, BATCH).alias(name) for name in values]
        return versions.groupBy(*keys).agg(*newest, F.max(BATCH).alias(BATCH)).select(*versions.columns)

    return survivors


def newest_batch(versions: DataFrame) -> DataFrame:
    """Survivors of complete mode: the rows of the newest batch."""
    newest = versions.agg(F.max(BATCH).alias(BATCH))
    return versions.join(F.broadcast(newest), BATCH, "left_semi").select(*versions.columns)


def latest_batch(versions: DataFrame) -> DataFrame:
    """Rows of the newest batch, for complete mode, where a batch is the whole result."""
    newest = versions.agg(F.max(BATCH).alias(BATCH))
    return versions.join(F.broadcast(newest), BATCH, "left_semi").drop(BATCH).distinct()

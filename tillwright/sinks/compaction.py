"""Few large files instead of many small ones.

Both ways pack the small files when the scan is planned: Spark's file splits are told to
grow to the target size, every task reads one split of many files and writes one file.
Nothing is shuffled and no task sees more than the target size.

A folder that a stream keeps writing to is compacted in runs.  A run packs the files no earlier one
took and then notes their names; the note is what makes it count, so a broken run is simply done
again.  Readers use a view over the runs and over the originals no run has noted, so they see a row
once at any time, new ones included.  Originals are removed some time after their run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillwright.sinks.files import children, delete

TARGET_BYTES = 512 << 20


def _packing(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session of its own, so that other queries keep their scan settings."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.files.maxPartitionBytes": target_bytes,
        "spark.sql.files.openCostInBytes": 1,
        "spark.sql.files.minPartitionNum": 1,
    }.items():
        session.conf.set(key, str(value))
    return session


def compact_folder(
    spark: SparkSession, source: str, target: str, target_bytes: int = TARGET_BYTES, compare_rows: bool = False
) -> int:
    """Rewrite a parquet folder into a new one and check it before anyone reads it.

    Row counts come from the footers of both sides; ``compare_rows`` also compares a
    checksum over all rows.  Returns the number of rows.
    """
    session = _packing(spark, target_bytes)
    before = session.read.parquet(source)
    before.write.parquet(target)
    after = session.read.schema(before.schema).parquet(target)
    for measure in (DataFrame.count, *([row_checksum] if compare_rows else [])):
        if measure(before) != measure(after):
            raise RuntimeError(f"{target} does not hold the rows of {source}; {source} is left as it was")
    return after.count()


#: What a run notes of each original: its name as Spark lists it, when that was, and the run, which is the notes' folder.
NOTES = "path string, at timestamp, run int"


def _notes(spark: SparkSession, target: str) -> DataFrame:
    try:
        return spark.read.schema(NOTES).parquet(f"{target}/notes")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], NOTES)


def _noted_runs(spark: SparkSession, target: str) -> list[int]:
    """Runs whose notes are whole, oldest first."""
    runs = [name.removeprefix("run=") for name in children(spark, f"{target}/notes") if name.startswith("run=")]
    return sorted(int(run) for run in runs if "_SUCCESS" in children(spark, f"{target}/notes/run={run}"))


def _last_run(spark: SparkSession, target: str) -> int:
    return max(_noted_runs(spark, target), default=0)


def _uniform(path: Column | str) -> Column:
    """Spark lists local files as ``file:///x`` and reads them as ``file:/x``."""
    return F.regexp_replace(path, "^file:/+", "file:///")


def compact_run(
    spark: SparkSession, source: str, target: str, schema: StructType, now: dt.datetime, target_bytes: int = TARGET_BYTES
) -> int:
    """Pack what is in ``source`` and was in no run before; returns how many files that were.

    ``source`` may hold folders of files, as the router writes them.  Of a stream's folder only
    finished files are taken.  What is there and what was noted are joined as tables; only the names of the run's own
    files come to the driver, which has to name them to the reader.  Rows are counted in the pass that writes them.
    """
    session = _packing(spark, target_bytes)
    # Only listed: the contents are a column that nothing reads.
    listed = session.read.format("binaryFile").options(recursiveFileLookup=True, ignoreMissingFiles=True).load(source)
    listed = listed.where(F.col("path").endswith(".parquet")).select(_uniform("path").alias("path"))
    noted = _notes(session, target).select(_uniform("path").alias("path"))
    new = sorted(row["path"] for row in listed.join(noted, "path", "left_anti").collect())
    if not new:
        return 0
    run = _last_run(session, target) + 1
    data = f"{target}/data/run={run}"
    before, counted = session.read.schema(schema).parquet(*new), None
    if not before.isEmpty():  # a write that adaptive execution finds empty measures nothing
        counted = Observation()
        before = before.observe(counted, F.count(F.lit(1)).alias("rows"))
    before.write.mode("overwrite").parquet(data)
    if (counted.get["rows"] if counted else 0) != session.read.schema(schema).parquet(data).count():
        raise RuntimeError(f"{data} does not hold the rows of {source}; readers still use the originals")
    notes = session.createDataFrame([(path, now) for path in new], "path string, at timestamp")
    notes.coalesce(1).write.mode("overwrite").parquet(f"{target}/notes/run={run}")
    return len(new)


def view_compacted(spark: SparkSession, view: str, files: str, target: str, schema: StructType) -> None:
    """``view`` over all runs and the rows of table ``files`` that no run has noted."""
    columns = ", ".join(f"`{name}`" for name in schema.names)
    path = "regexp_replace(url_decode(replace(f._metadata.file_path, '+', '%2B')), '^file:/+', 'file:///')"
    run = _last_run(spark, target)
    if not run:
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {files}")
        return
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS "
        f"SELECT {columns} FROM parquet.`{target}/data` WHERE run <= {run} UNION ALL "
        f"SELECT {columns} FROM {files} AS f LEFT ANTI JOIN "
        f"(SELECT path FROM parquet.`{target}/notes` WHERE run <= {run}) AS n ON {path} = n.path"
    )


def retire_originals(spark: SparkSession, target: str, before: dt.datetime) -> int:
    """Remove the originals of runs made before a time; returns how many were still there.

    Notes of originals that are gone say nothing more.  Those of a run that an earlier call found old are dropped, but
    for the newest run's, whose number the next one follows; so neither notes nor this walk grow with the stream's age.
    """
    old = _notes(spark, target).where(F.col("at") < F.lit(before))
    runs = {row["run"] for row in old.select("run").distinct().collect()}
    removed, gone = 0, []
    for run in sorted(runs):
        found = [delete(spark, row["path"]) for row in old.where(F.col("run") == run).select("path").toLocalIterator()]
        removed += sum(found)
        if not any(found) and run != _last_run(spark, target):
            gone.append(run)
    for run in gone:
        delete(spark, f"{target}/notes/run={run}")
    return removed


def row_checksum(rows: DataFrame) -> int:
    """Checksum of all rows in any order, summed as decimal so that it cannot overflow."""
    hashed = F.xxhash64(*[F.col(name) for name in rows.columns]).cast("decimal(38,0)")
    return int(rows.agg(F.coalesce(F.sum(hashed), F.lit(0)).alias("checksum")).first()["checksum"])


def compact_new_files(
    spark: SparkSession, source: str, target: str, checkpoint: str, schema: StructType, target_bytes: int = TARGET_BYTES
) -> None:
    """Append what a live stream added to ``source`` since the last run to ``target``.

    Runs beside the stream that writes ``source``: that sink's log says which files are
    complete, the checkpoint says which were compacted, and each is compacted once, also
    after a failure.
    """
    session = _packing(spark, target_bytes)
    query = (
        session.readStream.schema(schema)
        .parquet(source)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

"""Report as CSV with a header, in one file or in several."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame

from tillwright.session import work_folder
from tillwright.sinks.files import delete
from tillwright.sources.raw_zone import write_csv


def report_folder(root: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{day:%d-%m-%Y}"


def write_csv_report(report: DataFrame, folder: str, order: list[Column], files: str = "one") -> int:
    """Write ``report`` in ``order``, replacing an earlier run; returns its number of rows.

    ``files`` is ``one``, a single file whatever its size, or ``many``, files whose names sort in
    report order and that tasks write in parallel.  The report is staged as parquet first, so it is
    computed once and its rows can be counted from the footers; the staged copy is removed.
    """
    if files not in ("one", "many"):
        raise ValueError(f"files is 'one' or 'many', not {files!r}")
    spark = report.sparkSession
    staging = work_folder(spark, "report")
    report.write.parquet(staging)
    try:
        staged = spark.read.schema(report.schema).parquet(staging)
        ordered = staged.repartition(1).sortWithinPartitions(*order) if files == "one" else staged.orderBy(*order)
        write_csv(ordered, folder)
        return staged.count()
    finally:
        delete(spark, staging)

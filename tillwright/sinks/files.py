"""Listing and removing files through the file system that Spark reads them from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all in it; False where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where there is no folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in files.listStatus(target)) if files.exists(target) else []

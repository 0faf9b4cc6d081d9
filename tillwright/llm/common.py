"""Helpers shared by the operators: reading tables, stored intermediates, Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tillwright.session import work_folder

#: Rows of an Arrow batch that are worked on at a time, so that a batch of long texts does not
#: exist several times over in Python.
SLICE_ROWS = 1000

#: Most bytes of a batch of rows on its way to a Python worker.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20

K = TypeVar("K")
V = TypeVar("V")


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers import this package, and bound what they are sent at a time.

    The folder of the package is put on their import path; on a cluster the package is installed or sent
    with ``--py-files``, and then this changes nothing.  Batches of rows are bounded in bytes, as a
    few thousand texts can be long.
    """
    now = spark.conf.get(BATCH_SETTING).rstrip("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of a folder of tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written once below the shared folder and read again.

    This cuts lineage: a lost executor costs the tasks that ran on it and not the stages
    before, and what is random or depends on row order is drawn only once.
    """
    path = work_folder(spark, f"llm-{purpose}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


class Memo(dict[K, V]):
    """Results of a function by argument, emptied when it holds ``most`` of them.

    Words repeat, so a task works out each one about once; emptying bounds its memory and
    costs time only, never results.
    """

    def __init__(self, function: Callable[[K], V], most: int):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, key: K) -> V:
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.function(key)
        return value


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal ``keys`` together, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for start, end in zip(starts, starts[1:], strict=False):
            key = tuple(column[start] for column in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def grouped(
    frame: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``work`` on each group of equal ``keys``, without a Python call of Spark's per group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, keys):
            if (made := work(group)) is not None:
                yield made

    return frame.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)

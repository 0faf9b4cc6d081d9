"""Lloyd's clustering with the components of the vectors dealt over shards.

**Layout.**  Vectors are packed in chunks, and a chunk is cut into blocks of columns, one per shard.  A
block is one row, so rows are few and sums are matrix sums.

**Assignment.**  Every block gives the exact squared distances of its columns to the same columns of all
centroids.  The blocks of a chunk are added up by chunk, and the smallest sum is the nearest
centroid.

**Update.**  Assignments go back to the blocks of their chunk.  A shard adds up its own columns per
cluster, within its tasks first, and replaces its own slice of the centroids.  Centroids are
``k`` times the number of components, whatever the number of vectors.

Everything is integers, so neither order nor number of tasks matters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import grouped, slices, stored

CLUSTERS, ROUNDS = 16, 3
COMPONENTS, SCALE = 64, 64
#: Shards the components are dealt over, and vectors of a chunk.
SHARDS, CHUNK = 4, 1024
#: Components beyond this would not leave room for a squared distance in 64 bits.
MOST = 1 << 27

_BLOCKS = "chunk long, shard int, block binary"
_ASSIGNED = "chunk long, cluster binary, distance binary"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def kept(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector`` of integers, of the rows with exactly ``components`` finite components.

    A component ``x`` becomes ``floor(scale * x)`` in double precision; one beyond ``MOST`` raises, as distances would
    not fit 64 bits.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = rows.where(F.coalesce((F.size("vector") == components) & finite, F.lit(False)))

    def whole(x: Column) -> Column:
        scaled = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x) * scale <= MOST, scaled).otherwise(F.raise_error(F.lit(f"a component exceeds {MOST} / {scale}")))

    return rows.select("vec_id", F.transform("vector", whole).alias("vector"))


def first_centroids(rows: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """Vectors of the ``k`` ids with the smallest hashes, in their order; rows of one id by their components.

    Rows without id have no hash and are none of them.
    """
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = rows.where("vec_id IS NOT NULL").orderBy(order, "vector").limit(k).collect()
    return np.array([row["vector"] for row in first], np.int64)


def column_blocks(spark: SparkSession, rows: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """Stored tables: ids of each chunk, and its blocks of columns, one per shard."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches, CHUNK):
            if not batch.num_rows:
                continue
            column = batch.column("vector")
            matrix = column.flatten().to_numpy().astype(np.int32).reshape(batch.num_rows, -1)
            ids = batch.column("vec_id").to_pylist()
            parts = np.array_split(matrix, shards, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * shards, pa.int64()), pa.array(range(shards), pa.int32()),
                    pa.array([part.tobytes() for part in parts], pa.binary()),
                    pa.array([ids] + [None] * (shards - 1), pa.list_(pa.int64())),
                ],
                ["chunk", "shard", "block", "ids"],
            )
            number += 1

    made = stored(spark, rows.mapInArrow(chunks, _BLOCKS + ", ids array<long>"), "blocks")
    return made.where("ids IS NOT NULL").select("chunk", "ids"), made.select("chunk", "shard", "block")


def _slices(centroids: np.ndarray, shards: int) -> list[np.ndarray]:
    return np.array_split(centroids, shards, axis=1)


def assign(blocks: DataFrame, centroids: np.ndarray, shards: int = SHARDS) -> DataFrame:
    """Per chunk the nearest centroid of each vector, ties to the smaller number, and its squared distance."""
    own = _slices(centroids, shards)

    def distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 16):
            made = []
            for shard, block in zip(batch.column("shard").to_pylist(), batch.column("block"), strict=True):
                at = own[shard]
                vectors = np.frombuffer(block.as_buffer(), np.int32).reshape(-1, at.shape[1]).astype(np.int64)
                made.append(np.stack([((vectors - c) ** 2).sum(axis=1) for c in at], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(made, pa.binary())], ["chunk", "sums"])

    def nearest(group: pa.Table) -> pa.RecordBatch:
        total = sum(np.frombuffer(part, np.int64) for part in group.column("sums").to_pylist())
        total = total.reshape(-1, len(centroids))
        cluster = total.argmin(axis=1)
        distance = np.take_along_axis(total, cluster[:, None], 1)
        return pa.RecordBatch.from_arrays(
            [
                group.column("chunk").combine_chunks()[:1], pa.array([cluster.astype(np.int32).tobytes()], pa.binary()),
                pa.array([distance.tobytes()], pa.binary()),
            ],
            ["chunk", "cluster", "distance"],
        )

    partial = blocks.select("chunk", "shard", "block").mapInArrow(distances, "chunk long, sums binary")
    return grouped(partial, ["chunk"], nearest, _ASSIGNED)


def updated(blocks: DataFrame, assigned: DataFrame, centroids: np.ndarray, shards: int = SHARDS) -> np.ndarray:
    """Every non-empty centroid replaced by the floor of the mean of its vectors, each shard its own columns."""
    k = len(centroids)
    widths = [part.shape[1] for part in _slices(centroids, shards)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((k, width), np.int64) for width in widths]
        counts = np.zeros((shards, k), np.int64)
        for batch in batches:
            for shard, block, clusters in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "cluster")), strict=True):
                cluster = np.frombuffer(clusters, np.int32)
                np.add.at(totals[shard], cluster, np.frombuffer(block, np.int32).reshape(-1, widths[shard]).astype(np.int64))
                counts[shard] += np.bincount(cluster, minlength=k)
        shard, cluster = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(shard, pa.int32()), pa.array(cluster, pa.int32()), pa.array(counts[shard, cluster]),
                pa.array([totals[s][c].tolist() for s, c in zip(shard, cluster, strict=True)], pa.list_(pa.int64())),
            ],
            ["shard", "cluster", "n", "total"],
        )

    joined = blocks.join(assigned.select("chunk", "cluster"), "chunk").select("shard", "block", "cluster")
    per_task = joined.mapInArrow(sums, "shard int, cluster int, n long, total array<long>")
    columns = per_task.select("shard", "cluster", "n", F.posexplode("total").alias("place", "x"))
    # Exact in decimals for any number of tasks; a row per centroid and component comes to the driver.
    exact = columns.groupBy("shard", "cluster", "place").agg(
        F.sum(F.col("x").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    starts = np.concatenate([[0], np.cumsum(widths)])
    new = centroids.copy()
    for row in exact.collect():
        new[row["cluster"], starts[row["shard"]] + row["place"]] = int(row["total"]) // row["n"]
    return new


def cluster(
    spark: SparkSession, vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS,
    scale: int = SCALE, shards: int = SHARDS,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that :func:`kept` keeps.

    ``vectors`` has ``vec_id`` and ``embedding``; other columns are not read.  Rows that are NULL, of another length, or hold a
    NULL, NaN or infinity take no part.  A row without id is clustered and is never a first centroid; repeated
    rows count each.  With fewer vectors than ``k`` there are fewer centroids; an empty table gives no rows.
    An empty cluster keeps its centroid.
    """
    rows = stored(spark, kept(vectors, components, scale), "vectors")
    centroids = first_centroids(rows, k)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    ids, blocks = column_blocks(spark, rows, shards)
    for _ in range(rounds):
        centroids = updated(blocks, stored(spark, assign(blocks, centroids, shards), "assigned"), centroids, shards)
    assigned = stored(spark, assign(blocks, centroids, shards), "assigned")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, clusters, distances in zip(*(batch.column(c) for c in ("ids", "cluster", "distance")), strict=True):
                yield pa.RecordBatch.from_arrays(
                    [
                        own.values, pa.array(np.frombuffer(clusters.as_buffer(), np.int32)),
                        pa.array(np.frombuffer(distances.as_buffer(), np.int64)),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    placed = ids.join(assigned, "chunk").mapInArrow(unpack, "vec_id long, cluster int, distance long")
    inertias = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row per cluster
    total = sum(row["cluster_inertia"] for row in inertias)
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    known = [(row["cluster"], row["cluster_inertia"], total, digests[row["cluster"]]) for row in inertias]
    facts = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    columns = [name.split()[0] for name in RESULT.split(", ")]
    return placed.join(F.broadcast(facts), "cluster").select(*columns)  # at most ``k`` rows

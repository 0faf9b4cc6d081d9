"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

In a uniform random permutation of all rows, how many rows of a partition land in a shard is
hypergeometric.  So the matrix of those counts is drawn first, exactly: partition by partition,
from what the shards have left.  Then every partition permutes its rows locally and deals the
permuted rows out by its line of the matrix, one exchange moves them, and every shard permutes
what it got.  Shard sizes are exact and at most one row apart.

The rows are moved by DataFrame functions only.  The matrix has a line per partition; it is drawn
on the driver, and its lines go back as one literal.
"""

from __future__ import annotations

import json
import random
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.common import stored

SHARDS = 8
SEED = 20240901
#: Least ranges a shard is permuted in, each by one task.
RANGES = 512
LAW = "rows"


def hypergeometric(rng: random.Random, draws: int, marked: int, others: int) -> int:
    """How many of ``draws`` rows taken without replacement from ``marked + others`` are marked.

    Inversion from the mode outwards: exact up to double precision, in time of the order of the
    standard deviation.
    """
    low, high = max(0, draws - others), min(draws, marked)
    if low == high:
        return low
    mode = (draws + 1) * (marked + 1) // (marked + others + 2)
    mode = min(max(mode, low), high)

    def up(k: int) -> float:
        """P(k + 1) / P(k)"""
        return (marked - k) * (draws - k) / ((k + 1) * (others - draws + k + 1))

    # Weights relative to the mode, as far as they matter in double precision.
    right, k, weight = [], mode, 1.0
    while k < high and weight > 1e-18:
        weight *= up(k)
        k += 1
        right.append(weight)
    left, k, weight = [], mode, 1.0
    while k > low and weight > 1e-18:
        weight /= up(k - 1)
        k -= 1
        left.append(weight)
    u = rng.random() * (1.0 + sum(right) + sum(left))
    if u < 1.0:
        return mode
    u -= 1.0
    for i, weight in enumerate(right):
        if u < weight:
            return mode + 1 + i
        u -= weight
    for i, weight in enumerate(left):
        if u < weight:
            return mode - 1 - i
        u -= weight
    return mode


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def communication_matrix(counts: dict[int, int], sizes: list[int], seed: int = SEED) -> dict[int, list[int]]:
    """For every partition the number of its rows that go to each shard."""
    rng, left, matrix = random.Random(seed), list(sizes), {}
    for partition in sorted(counts):
        draws, rest, line = counts[partition], sum(left), []
        for shard, room in enumerate(left):
            rest -= room
            line.append(hypergeometric(rng, draws, room, rest))
            draws -= line[-1]
            left[shard] -= line[-1]
        matrix[partition] = line
    return matrix


def ranges_for(partitions: int, shards: int, least: int = RANGES) -> int:
    """Ranges of a shard such that each holds no more than about an input partition."""
    return max(least, -(-partitions // shards))


def _free(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column has it."""
    while name.lower() in {column.lower() for column in taken}:
        name = "_" + name
    return name


def shuffle_into_shards(
    spark: SparkSession, frame: DataFrame, shards: int = SHARDS, seed: int = SEED, ranges: int | None = None
) -> DataFrame:
    """All rows of ``frame`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in its shard).

    The rows are stored once, permuted within their partition, with the partition and their place
    there; that freezes every random draw, so repeated tasks see the same ones.  One exchange then
    moves each row to one of ``ranges`` ranges of its shard, which is sorted by a second random
    key.  Ranges are random too, so repeated rows and hot values spread as all others do; unless
    ``ranges`` is given, there are so many that one is about an input partition at most.  On the driver are a line of ``shards``
    numbers per partition and one number per shard and range.

    NULLs and repeated rows are rows like others.  An empty table gives no rows.  Columns of
    ``frame`` called ``shard`` or ``slot`` are replaced.
    """
    frame = frame.drop("shard", "slot")
    partition, place, key, part, offset = (
        _free(name, frame.columns) for name in ("partition", "place", "key", "range", "offset")
    )
    local = (
        frame.withColumns({partition: F.spark_partition_id(), key: F.rand(seed)})
        .sortWithinPartitions(key)
        .withColumn(place, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .drop(key)
    )
    rows = stored(spark, local, "permuted")
    counts = dict(rows.groupBy(partition).agg(F.count("*")).toLocalIterator())
    ranges = ranges or ranges_for(len(counts), shards)
    matrix = communication_matrix(counts, shard_sizes(sum(counts.values()), shards), seed)

    # A line of the matrix as the ends of the runs that each shard gets from the permuted partition.
    ends = [list(accumulate(matrix.get(p, [0] * shards))) for p in range(max(counts, default=-1) + 1)]
    line = F.get(F.from_json(F.lit(json.dumps(ends)), "array<array<bigint>>"), F.col(partition))
    shard = F.size(F.filter(line, lambda end: end <= F.col(place)))
    dealt = rows.withColumns({"shard": shard, key: F.xxhash64(F.lit(seed), partition, place)}).withColumn(
        part, F.pmod(key, F.lit(ranges)).cast("int")
    )

    sizes = dealt.groupBy("shard", part).agg(F.count("*").alias(offset))
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn(offset, F.coalesce(F.sum(offset).over(before), F.lit(0)))
    order = Window.partitionBy("shard", part).orderBy(key, partition, place)
    # Bounded: a row for every shard and range.
    return (
        dealt.withColumn("slot", F.row_number().over(order).cast("long"))
        .join(F.broadcast(offsets), ["shard", part])
        .withColumn("slot", F.col("slot") - 1 + F.col(offset))
        .select(*frame.columns, "shard", "slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder for each shard, its files in order of slots."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def text_digests(sharded: DataFrame) -> DataFrame:
    """What identifies a sharded text: ``doc_id, size`` (UTF-8 bytes and one), ``text_crc32`` and its place."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return sharded.select(
        "doc_id",
        (F.length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        F.col("shard"),
        F.col("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

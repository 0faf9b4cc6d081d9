"""Rows of a batch whose key is not stored yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most bytes of keys that are broadcast, and what a row costs beyond its key.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32


def new_rows(batch: DataFrame, stored: DataFrame, key: str, one_per_key: bool = False) -> DataFrame:
    """Left-anti join on ``key``; only the key column of ``stored`` is read.

    The first version of a key wins over later batches.  Rows without a key match
    nothing, so they would be appended by every run; they are left out.  Within a batch
    all rows of a new key stay, unless ``one_per_key`` keeps the smallest of each.
    """
    keyed = batch.where(F.col(key).isNotNull())
    if one_per_key:
        keyed = first_per_key(keyed, key)
    return keyed.join(stored.select(key), key, "left_anti").select(*batch.columns)


def first_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest by the other columns, so that reruns agree.

    ``min`` combines before the shuffle: a key with a third of all rows costs one
    buffer per task.
    """
    others = [name for name in rows.columns if name != key]
    return (
        rows.groupBy(key)
        .agg(F.min(F.struct(*others)).alias("first_row"))
        .select(key, *[F.col("first_row")[name].alias(name) for name in others])
        .select(*rows.columns)
    )


def new_rows_for_small_batch(
    batch: DataFrame, stored: DataFrame, key: str, one_per_key: bool = False, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """:func:`new_rows` for an hourly batch against a dimension that keeps growing.

    An anti join can only broadcast its right side, so a stored dimension beyond the
    broadcast limit would be shuffled every hour.  Where the distinct keys of the batch
    measure at most ``broadcast_bytes``, the stored keys are first cut down to those of
    the batch, scanning them where they lie; what is left is no larger than the batch
    and is broadcast in turn.  A larger batch takes the plain join.  ``batch`` is
    evaluated more than once and should be persisted.
    """
    keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
    if _bytes(keys, key) > broadcast_bytes:
        return new_rows(batch, stored, key, one_per_key)
    hits = stored.select(key).join(F.broadcast(keys), key, "left_semi").distinct()
    return new_rows(batch, F.broadcast(hits), key, one_per_key)


def _bytes(keys: DataFrame, key: str) -> int:
    size = F.octet_length(F.col(key).cast("string")) + ROW_BYTES
    return keys.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]

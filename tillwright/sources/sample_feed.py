"""Replaying a stored log to a stream in a fixed order.

A watermark drops rows by the order they arrive in.  To give the same result on every
run, the log is delivered in drops, and the stream works off each drop before the next.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def time_slices(log: DataFrame, column: str, slices: int) -> list[Column]:
    """Conditions that cut a log into equal spans of time, earliest first."""
    first, last = log.agg(F.min(column), F.max(column)).first()
    if first is None:
        return []
    step = (last - first) / slices
    time = F.col(column)
    bounds = [_literal(log, column, first + step * n) for n in range(1, slices)]
    lower = [F.lit(True), *[time >= bound for bound in bounds]]
    upper = [*[time < bound for bound in bounds], F.lit(True)]
    cuts = [low & high for low, high in zip(lower, upper)]
    return [cuts[0] | time.isNull(), *cuts[1:]]


def _literal(log: DataFrame, column: str, moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast(log.schema[column].dataType)


def replay(
    log: DataFrame,
    drops: Iterable[Column],
    message: Callable[[DataFrame], DataFrame],
    inbox: str,
    start: Callable[[str], StreamingQuery],
) -> None:
    """Append each drop's messages to ``inbox`` and let a query from ``start`` finish it.

    Every drop restarts the query on its checkpoint.
    """
    for drop in drops:
        message(log.where(drop)).write.mode("append").parquet(inbox)
        start(inbox).awaitTermination()

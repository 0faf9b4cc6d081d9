"""Inner star joins under a sum or count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """A dimension, and the fact column that refers to its key."""

    dimension: DataFrame
    fact_key: str
    key: str


def sum_by_attributes(fact: DataFrame, lookups: list[Lookup], by: list[str], sums: dict[str, Column]) -> DataFrame:
    """``SELECT by, sums FROM fact JOIN dimensions GROUP BY by``, aggregated below the joins.

    ``sums`` are sum or count expressions on the fact.  They are first taken per
    combination of foreign keys, then joined, then summed per attribute.  Sums and
    counts split like that without changing the result, repeated dimension keys
    included.  So the join moves one row per key instead of the fact, and a hot key is
    combined away before anything is shuffled.
    """
    keys = [lookup.fact_key for lookup in lookups]
    rows = fact.groupBy(*keys).agg(*[expression.alias(name) for name, expression in sums.items()])
    for lookup in lookups:
        attributes = [name for name in lookup.dimension.columns if name in by]
        dimension = lookup.dimension.select(F.col(lookup.key).alias(lookup.fact_key), *attributes)
        rows = rows.join(dimension, lookup.fact_key, "inner")
    return rows.groupBy(*by).agg(*[F.sum(name).alias(name) for name in sums])

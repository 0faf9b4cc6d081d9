from __future__ import annotations

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tillwright.llm import sharded_lloyd as sl

VECTORS = "vec_id long, embedding array<float>"


def by_hand(rows, k, rounds, components, scale=64):
    kept = [
        (vec_id, [math.floor(scale * x) for x in vector])
        for vec_id, vector in rows
        if vector is not None and len(vector) == components and all(x is not None and math.isfinite(x) for x in vector)
    ]
    order = lambda row: (hashlib.sha256(f"1:{row[0]}".encode()).hexdigest(), row[1])
    centroids = [v for _, v in sorted((r for r in kept if r[0] is not None), key=order)[:k]]
    if not centroids:
        return []

    def assigned():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        groups = {}
        for (_, v), (_, i) in zip(kept, assigned()):
            groups.setdefault(i, []).append(v)
        for i, members in groups.items():
            centroids[i] = [sum(column) // len(members) for column in zip(*members)]
    last = assigned()
    own = {i: sum(d for d, j in last if j == i) for _, i in last}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        ((vec_id, i, d, own[i], sum(own.values()), digest[i]) for (vec_id, _), (d, i) in zip(kept, last)), key=str
    )


def clustered(spark, rows, **how):
    frame = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, VECTORS)
    return sorted(map(tuple, sl.cluster(spark, frame, **how).collect()), key=str)


def vectors(seed, size, components):
    rng = random.Random(seed)
    step = lambda: rng.randrange(-256, 256) / 128  # noqa: E731  the same as a float and as a double
    return [(i, [step() for _ in range(components)]) for i in range(size)]


@pytest.mark.parametrize("shards", [1, 3, 8])
@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_clusters_are_those_by_hand(spark, shards, rounds, monkeypatch):
    monkeypatch.setattr(sl, "CHUNK", 7)
    rows = vectors(shards, 90, 8)
    found = clustered(spark, rows, k=5, rounds=rounds, components=8, shards=shards)
    assert found == by_hand(rows, 5, rounds, 8)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0, 3.0])]
    rows += [(None, [0.5, 0.5]), (10, [-0.01, 0.01]), (10, [-0.01, 0.01]), (10, [2.0, 2.0]), (11, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({"chunk": F.lit("x"), "cluster": F.lit(9), "vector": F.lit(0)})
    assert clustered(spark, frame, k=3, components=2, shards=2) == by_hand(rows, 3, 3, 2)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(i, [1.0, 1.0]) for i in range(9)] + [(100, [3.0, 3.0])]
    found = clustered(spark, rows, k=6, components=2, shards=2)
    assert found == by_hand(rows, 6, 3, 2) and len({row[1] for row in found}) == 2


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = vectors(4, 3, 4)
    assert clustered(spark, rows, k=16, components=4) == by_hand(rows, 16, 3, 4)
    empty = sl.cluster(spark, spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns == [f.split()[0] for f in sl.RESULT.split(", ")]
    assert clustered(spark, [(None, [1.0, 2.0])], components=2) == []  # no vector can be a centroid


def test_components_that_leave_no_room_raise(spark):
    assert clustered(spark, [(1, [float(1 << 21)]), (2, [-float(1 << 21)])], k=1, rounds=0, components=1, shards=1)[0][2] >= 0
    with pytest.raises(Exception, match="exceeds"):
        clustered(spark, [(1, [1e30])], k=1, components=1, shards=1)

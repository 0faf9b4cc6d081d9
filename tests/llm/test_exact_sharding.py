from __future__ import annotations

import math
import random
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tillwright.llm import exact_sharding as es


def test_hypergeometric_draws_have_the_exact_distribution():
    rng, draws, marked, others = random.Random(1), 7, 5, 9
    n = 40_000
    seen = Counter(es.hypergeometric(rng, draws, marked, others) for _ in range(n))
    for k in range(6):
        p = math.comb(marked, k) * math.comb(others, draws - k) / math.comb(marked + others, draws)
        assert abs(seen[k] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-9
    assert es.hypergeometric(rng, 5, 0, 9) == 0 and es.hypergeometric(rng, 14, 5, 9) == 5
    large = [es.hypergeometric(rng, 10**7, 10**9, 7 * 10**9) for _ in range(50)]
    assert abs(sum(large) / 50 - 10**7 / 8) < 5 * (10**7 * 7 / 64 / 50) ** 0.5


def test_matrix_has_the_sizes_of_partitions_and_shards():
    counts = {0: 17, 1: 0, 2: 900, 5: 3}
    sizes = es.shard_sizes(sum(counts.values()), 8)
    matrix = es.communication_matrix(counts, sizes, 3)
    assert {p: sum(line) for p, line in matrix.items()} == counts
    assert [sum(line[s] for line in matrix.values()) for s in range(8)] == sizes and max(sizes) - min(sizes) <= 1


def test_all_rows_are_dealt_once_and_slots_are_gapless(spark, docs):
    frame = docs(*[(i, f"text {i}") for i in range(997)]).repartition(7)
    rows = es.shuffle_into_shards(spark, frame, ranges=16).collect()
    assert Counter(row.doc_id for row in rows) == Counter(range(997))
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(found == list(range(len(found))) for found in slots.values())
    assert sorted(map(len, slots.values())) == [124] * 3 + [125] * 5


def test_dealing_equals_a_dealer_by_hand(spark, monkeypatch):
    """Permuted partitions dealt row by row from the matrix, shards put in order of range and key."""
    kept, stored = [], es.stored
    monkeypatch.setattr(es, "stored", lambda *args: kept.append(stored(*args)) or kept[-1])
    made = es.shuffle_into_shards(spark, spark.range(0, 700, numPartitions=6).where("id % 6 < 4"), 5, 11, ranges=4)
    got = {r.id: (r.shard, r.slot) for r in made.collect()}
    keyed = kept[0].withColumn("drawn", F.xxhash64(F.lit(11), "partition", "place"))
    rows = sorted(keyed.collect(), key=lambda r: (r.partition, r.place))
    counts = Counter(r.partition for r in rows)
    assert [r.place for r in rows] == [k for p in sorted(counts) for k in range(counts[p])]
    matrix = es.communication_matrix(counts, es.shard_sizes(len(rows), 5), 11)
    hands = {p: [s for s, n in enumerate(line) for _ in range(n)] for p, line in matrix.items()}
    shards = [[] for _ in range(5)]
    for row in rows:
        shards[hands[row.partition][row.place]].append((row.drawn % 4, row.drawn, row.partition, row.place, row.id))
    assert got == {row[-1]: (s, k) for s, shard in enumerate(shards) for k, row in enumerate(sorted(shard))}


def test_ranges_grow_with_the_partitions():
    assert [es.ranges_for(p, 8) for p in (0, 1, 4096, 4097, 800_000)] == [512, 512, 512, 513, 100_000]


def test_places_are_uniform(spark):
    """Rows of any partition and place spread over all shards and slots."""
    rows = es.shuffle_into_shards(spark, spark.range(0, 20_000, numPartitions=5), 8, ranges=32).collect()
    table = Counter((r.id // 4000, r.shard) for r in rows)
    chi = sum((table[p, s] - 500) ** 2 / 500 for p in range(5) for s in range(8))
    assert chi < 28 + 5 * (2 * 28) ** 0.5
    n = len(rows)
    place = [r.id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    mean = (n - 1) / 2
    correlation = sum((i - mean) * (x - mean) for i, x in enumerate(place)) / sum((i - mean) ** 2 for i in range(n))
    assert abs(correlation) < 5 / n**0.5


def test_nulls_repeats_clashing_names_and_empty_tables(spark, docs):
    frame = docs((None, None), (1, ""), (1, ""), (2, "é")).withColumns(
        {"shard": F.lit("old"), "partition": F.lit("mine"), "key": F.lit(5)}
    )
    made = es.shuffle_into_shards(spark, frame, 3)
    rows = made.collect()
    assert len(rows) == 4 and {r.partition for r in rows} == {"mine"} and {r.key for r in rows} == {5}
    assert sorted(Counter(r.shard for r in rows).values()) == [1, 1, 2]
    digests = {r.doc_id: (r["size"], r.text_crc32) for r in es.text_digests(made).collect()}
    assert digests == {None: (1, 0), 1: (1, 0), 2: (3, zlib.crc32("é".encode()))}
    assert es.shuffle_into_shards(spark, docs()).collect() == []


def test_no_python_runs_on_executors(spark, docs):
    plan = es.shuffle_into_shards(spark, docs((1, "a")).select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_shards_are_written_in_order(spark, tmp_path):
    made = es.shuffle_into_shards(spark, spark.range(100), 4)
    es.write_shards(made, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().collect()
    assert sorted((r.shard, r["count"]) for r in back) == [(s, 25) for s in range(4)]

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwright.llm import nn_descent as nd
from tillwright.llm.common import prepare_workers

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def table(spark):
    prepare_workers(spark)

    def make(vectors, ids=None):
        rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids or range(len(vectors)), vectors)]
        return spark.createDataFrame(rows, SCHEMA)

    return make


def exact(vectors, every, most):
    """Per query the nearest rows by inner product, ties by id."""
    matrix = np.asarray(vectors, np.float32).astype(np.float64)
    answers = {}
    for q in range(0, len(matrix), every):
        scores = matrix @ matrix[q]
        order = [i for i in np.lexsort((np.arange(len(matrix)), -np.round(scores, 12))) if i != q]
        answers[q] = [(int(i), float(scores[i])) for i in order[:most]]
    return answers


def found(frame):
    answers = {}
    for row in frame.orderBy("query_id", "rank").collect():
        answers.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(answers[row.query_id])
    return answers


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_recall_on_clusters_and_on_noise(spark, table, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 150)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 16))
    vectors = np.concatenate([centres[rng.integers(0, 30, 900)] + 0.3 * rng.standard_normal((900, 16)), rng.standard_normal((600, 16))])
    got, want = found(nd.nearest(spark, table(vectors))), exact(vectors, 20, 20)
    assert set(got) == set(want) and all(len(a) == 20 for a in got.values())
    assert recall(got, want) >= 0.9
    for q, answer in got.items():
        assert [s for _, s in answer] == sorted((s for _, s in answer), reverse=True)
        assert np.allclose([s for _, s in answer], [np.float32(vectors[q]).astype(float) @ np.float32(vectors[i]).astype(float) for i, _ in answer])


def test_few_rows_are_answered_exactly_with_ties_by_id(spark, table):
    vectors = [[1, 0], [0, 1], [1, 0], [1, 1], [-1, 0], [1, 0], [2, 0]]
    got = found(nd.nearest(spark, table(vectors), every=2, most=4))
    assert {q: [i for i, _ in a] for q, a in got.items()} == {q: [i for i, _ in a] for q, a in exact(vectors, 2, 4).items()}


def test_many_copies_of_one_vector(spark, table, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 100)
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((900, 8))
    vectors[300:700] = 4 * vectors[300]
    got, want = found(nd.nearest(spark, table(vectors))), exact(vectors, 20, 20)
    assert [i for i, _ in got[320]] == [i for i, _ in want[320]] == list(range(300, 320))
    assert [i for i, _ in got[300]] == list(range(301, 321)) and recall(got, want) >= 0.95


def test_rows_that_take_no_part(spark, table):
    inf, nan = float("inf"), float("nan")
    vectors = [[1, 2], None, [0, 0], [1, None], [nan, 1], [inf, 1], [], [3, 1], [1, 2, 3], [2, 2]]
    frame = table(vectors, [0, 1, 2, 3, 4, 5, 6, 20, 40, None]).withColumns({"id": F.lit(1), "rank": F.lit("x"), "vector": F.lit(2)})
    assert {q: [i for i, _ in a] for q, a in found(nd.nearest(spark, frame)).items()} == {0: [20], 20: [0]}
    assert nd.nearest(spark, table([])).collect() == [] and nd.nearest(spark, table([[1, 2]])).collect() == []


def test_rows_with_one_id_are_queries_and_candidates_each(spark, table):
    rows = nd.nearest(spark, table([[1, 0], [0, 1], [1, 0], [2, 2]], [20, 20, 20, 7])).collect()
    answers = sorted((row.query_id, row["rank"], row.vec_id, row.score) for row in rows if row.query_id == 20)
    first, second = [(7, 2.0), (20, 1.0), (20, 0.0)], [(7, 2.0), (20, 0.0), (20, 0.0)]
    assert answers == sorted((20, k, *pair) for pairs in (first, second, first) for k, pair in enumerate(pairs, 1))


@pytest.mark.parametrize("times", [3_000, 100_000])
def test_recall_does_not_depend_on_one_long_vector(spark, table, times):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((6000, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[17] *= times
    got, want = found(nd.nearest(spark, table(vectors))), exact(vectors, 20, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    assert all(17 in {i for i, _ in got[q]} for q, answer in want.items() if 17 in {i for i, _ in answer})


def test_recall_with_lengths_of_many_sizes(spark, table, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 150)
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((20, 16))
    vectors = centres[rng.integers(0, 20, 1600)] + 0.4 * rng.standard_normal((1600, 16))
    vectors *= np.where(rng.random(1600) < 0.4, 1.0, 2.0 ** rng.integers(-9, 3, 1600))[:, None]
    got, want = found(nd.nearest(spark, table(vectors))), exact(vectors, 20, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_trees_are_balanced_and_deal_out_every_row():
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((1000, 5)).astype(np.float32)
    counts = np.bincount(nd.leaves(vectors, nd.fit_tree(vectors, 3, rng)), minlength=8)
    assert counts.sum() == 1000 and counts.min() > 100
    same = np.ones((64, 5), np.float32)
    assert nd.leaves(same, nd.fit_tree(same, 2, rng)).max() <= 3

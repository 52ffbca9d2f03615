"""Clustering against plain loops, and vectors that take no part."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import centroids as c


def plain(rows, count, rounds, scale):
    """The same rounds in plain Python integers."""
    points = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows]
    start = sorted(points, key=lambda p: hashlib.sha256(f"2:{p[0]}".encode()).hexdigest())[:count]
    means = [list(v) for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(means))
    for _ in range(rounds):
        groups = {}
        for _, v in points:
            groups.setdefault(near(v)[1], []).append(v)
        for k, own in groups.items():
            means[k] = [sum(x) // len(own) for x in zip(*own)]
    return {(i, near(v)[1], near(v)[0]) for i, v in points}, means


@pytest.mark.parametrize(("n", "count", "width"), [(300, 12, 8), (5, 40, 3), (60, 7, 1)])
def test_rounds_are_those_of_plain_loops(spark, n, count, width):
    rng = np.random.default_rng(n)
    rows = [(k, rng.normal(scale=2, size=width).round(2).tolist()) for k in range(n)]
    rows += [(n + k, rows[0][1]) for k in range(n // 2)]  # a third are copies of one vector
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found, means = c.clustered(vectors, count=count, rounds=3, width=width, scale=16)
    want, want_means = plain(rows, count, 3, 16)
    assert {tuple(r) for r in found.collect()} == want
    assert means.tolist() == want_means


def test_equal_distances_go_to_the_smaller_number(spark):
    far = c.distances(np.array([[0, 5], [4, 4]]), np.array([[0, 4], [0, 6], [0, 4]]))
    assert far.tolist() == [[1, 1, 1], [16, 20, 16]] and far.argmin(axis=1).tolist() == [0, 0]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0]), (7, [0.0, 0.0]), (None, [2.0, 2.0]), (1, [0.5, -0.5]), (8, [])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({n: F.lit("z") for n in ("x", "cluster", "n", "total")})
    found, means = c.clustered(vectors, width=2)
    assert sorted((r.vec_id or 0, r.distance) for r in found.collect()) == [(0, 0), (1, 0), (1, 0), (7, 0)]
    assert means[-1].tolist() == [512, 512]  # the null id starts the last cluster
    empty, none = c.clustered(vectors.limit(0), width=2)
    assert empty.collect() == [] and none.shape == (0, 2)
    with pytest.raises(Exception, match="beyond"):
        c.clustered(spark.createDataFrame([(1, [3e38])], "vec_id bigint, embedding array<float>"), width=1)


def test_means_round_down(spark):
    vectors = spark.createDataFrame([(1, [-1.0]), (2, [-2.0])], "vec_id bigint, embedding array<double>")
    _, means = c.clustered(vectors, count=1, rounds=1, width=1, scale=1)
    assert means.tolist() == [[-2]]

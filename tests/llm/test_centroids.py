"""Clustering in the Walsh-Hadamard domain against plain arithmetic on Python's numbers."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from railpulse.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string, id string, inertia string"


def whole(x):
    return math.floor(Fraction(x) * 256)


def slow(rows, k, rounds):
    kept = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((i is None, hashlib.sha256(f"2:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept)
    centres = [v for _, _, v in order[:k]]

    def assign():
        out = []
        for i, v in kept:
            dist = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((i, dist.index(min(dist)), min(dist), v))
        return out

    for _ in range(rounds):
        near = assign()
        for c in range(len(centres)):
            own = [v for _, cluster, _, v in near if cluster == c]
            if own:
                centres[c] = [sum(column) // len(own) for column in zip(*own)]
    near = assign()
    total = sum(d for _, _, d, _ in near)
    return sorted(((i, c, d, sum(d2 for _, c2, d2, _ in near if c2 == c), total, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                   for i, c, d, _ in near), key=str)


def fast(spark, rows, scratch, k, rounds):
    docs = spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, C.clusters(docs, scratch, k, rounds).collect()), key=str)


def vectors(seed, n, scale=1.0):
    return [[float(x) for x in row] for row in np.random.default_rng(seed).normal(size=(n, 64)) * scale]


def test_walsh_functions_are_orthogonal_and_ordered():
    matrix = C.walsh()
    assert (matrix @ matrix.T == 64 * np.eye(64)).all()
    assert [(np.diff(row) != 0).sum() for row in matrix] == list(range(64))


@pytest.mark.parametrize("scale", [0, 0.01, 1, 300])
def test_search_is_exact_and_takes_the_first_of_equals(scale):
    draw = np.random.default_rng(3)
    points = np.round(draw.normal(size=(500, 64)) * 256 * scale).astype(np.int64)
    centres = np.concatenate([points[:20], points[:20], points[100:110]])
    near, distance, _ = C.search(points, centres)
    plain = ((points[:, None] - centres[None]) ** 2).sum(2)
    assert (near == plain.argmin(1)).all() and (distance == plain.min(1)).all()


def test_far_centroids_are_out_before_the_end():
    """Smooth vectors differ in their coarse coefficients, so most differences are never taken."""
    level = np.repeat(np.arange(40), 20)[:, None] * 500
    points = (level + np.random.default_rng(1).integers(-20, 20, (800, 64))).astype(np.int64)
    near, _, taken = C.search(points, points[::20])
    assert (near == np.repeat(np.arange(40), 20)).all()
    assert taken < 800 * 40 * 64 / 4


def test_numbers_beyond_64_bits_stay_exact():
    points = np.array([[10 ** 30 + i] * 64 for i in range(5)], object)
    near, distance, _ = C.search(points, points[[0, 4]])
    assert near.tolist() == [0, 0, 0, 1, 1] and distance.tolist() == [0, 64, 256, 64, 0]
    assert C.whole(np.array([[1e308, -1e308, 0.7, -0.001]])).tolist() == [[int(1e308) * 256, -int(1e308) * 256, 179, -1]]


@pytest.mark.parametrize("k, rounds", [(5, 0), (5, 5), (1, 2), (40, 3)])
def test_rounds_against_plain_arithmetic(spark, scratch, k, rounds):
    rows = list(enumerate(vectors(k, 120)))
    rows += [(1000 + i, v) for i, (_, v) in enumerate(rows[:30])]                      # equal vectors
    rows += [(7, rows[7][1]), (None, vectors(9, 1)[0]), (None, vectors(8, 1)[0])]        # repeated rows, null ids
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 63 + [None]), (2004, [float("nan")] * 64), (2005, [float("inf")] * 64)]
    assert fast(spark, rows, scratch, k, rounds) == slow(rows, k, rounds)


def test_few_vectors_none_and_large_ones(spark, scratch):
    rows = [(i, v) for i, v in enumerate(vectors(1, 3))] + [(None, vectors(2, 1)[0])]
    assert fast(spark, rows, scratch, 40, 5) == slow(rows, 40, 5)
    assert fast(spark, [], scratch, 40, 5) == [] and fast(spark, [(1, None)], scratch, 40, 5) == []
    large = [(i, v) for i, v in enumerate(vectors(3, 20, 3e5))]
    assert fast(spark, large, scratch, 4, 3) == slow(large, 4, 3)
    with pytest.raises(Exception, match="64 bits"):
        fast(spark, [(i, v) for i, v in enumerate(vectors(4, 9, 1e30))], scratch, 2, 1)


def test_equal_vectors_leave_centroids_empty(spark, scratch):
    """All vectors alike: every one goes to centroid 0, and the others stay where they began."""
    rows = [(i, [1.5] * 64) for i in range(50)]
    found = fast(spark, rows, scratch, 40, 5)
    assert found == slow(rows, 40, 5) and {row[1] for row in found} == {0}

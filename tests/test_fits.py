"""Normal equations and Lloyd's rounds against plain versions."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest

from tillworks.operators import linear, lloyd


def test_coefficients_equal_least_squares(spark):
    draw = random.Random(2)
    rows = [(draw.randint(-9, 9), draw.randint(0, 5), draw.randint(-100, 100)) for _ in range(60)] + [(None, 1, 2)]
    frame = spark.createDataFrame(rows, "a int, b int, y long")
    x = np.array([(1, a, b) for a, b, _ in rows[:-1]], dtype=float)
    want = np.linalg.lstsq(x, np.array([y for *_, y in rows[:-1]], dtype=float), rcond=None)[0]
    assert linear.coefficients(frame, ["a", "b"], "y") == pytest.approx(list(want), abs=1e-9)


def test_dependent_columns_and_empty_tables(spark):
    rows = [(i, 2 * i, 7, 3 * i + 1) for i in range(5)]
    frame = spark.createDataFrame(rows, "a int, twice int, same int, y long")
    assert linear.coefficients(frame, ["a", "twice", "same"], "y") == [1.0, 3.0, 0.0, 0.0]
    assert linear.coefficients(frame.where("false"), ["a"], "y") == [0.0, 0.0]
    assert linear.solved([[0, 2, 4], [3, 1, 5]]) == [Fraction(1), Fraction(2)]


def test_sums_pass_64_bits(spark):
    big = 3_000_000_000
    frame = spark.createDataFrame([(big, big), (-big, -big), (1, 1)], "a long, y long")
    assert linear.gram(frame, ["a"], "y")[1] == [1, 2 * big * big + 1, 2 * big * big + 1]


def _plain(points, ks, rounds):
    keys = sorted(points)
    seeds = [points[keys[0]]]
    far = lambda k: min(sum((a - b) ** 2 for a, b in zip(points[k], s)) for s in seeds)
    while len(seeds) < max(ks) and max(map(far, keys)) > 0:
        seeds.append(points[max(keys, key=lambda k: (far(k), -k))])
    own = {}
    for k in ks:
        centres = [tuple(map(float, s)) for s in seeds[:k]]
        nearest = lambda p: min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centres))[1]
        for _ in range(rounds):
            members = {j: [p for p in points.values() if nearest(p) == j] for j in range(len(centres))}
            centres = [tuple(sum(v) / len(m) for v in zip(*m)) if m else centres[j] for j, m in members.items()]
        own |= {(key, k): nearest(p) for key, p in points.items()}
    return own


def test_rounds_equal_the_plain_ones(spark):
    draw = random.Random(4)
    points = {k: (draw.randint(0, 40), draw.randint(0, 40)) for k in range(80)} | {100: (3, 3), 101: (3, 3)}
    frame = spark.createDataFrame([(k, list(p)) for k, p in points.items()], "key long, x array<long>")
    got = {(r.key, r.k): r.cluster for r in lloyd.assigned(frame, lloyd.clustered(frame, [2, 3, 6])).collect()}
    assert got == _plain(points, [2, 3, 6], lloyd.ROUNDS)


def test_fewer_points_than_clusters(spark):
    frame = spark.createDataFrame([(1, [5]), (2, [5]), (3, [9])], "key long, x array<long>")
    centres = lloyd.clustered(frame, [2, 5])
    assert [len(c) for c in centres.values()] == [2, 2]
    none = frame.where("false")
    assert lloyd.assigned(none, lloyd.clustered(none, [2])).count() == 0

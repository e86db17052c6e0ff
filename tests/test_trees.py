"""Exact trees against a plain search over all thresholds."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tillworks.operators.ordering import with_running_totals_within
from tillworks.operators.trees import grown


def _plain(rows, depth, node=1):
    """Splits by node: (feature, threshold), tried over every feature and value."""
    if not depth or len({y for _, y in rows}) < 2:
        return {}
    best = None
    for f in range(len(rows[0][0])):
        values = sorted({x[f] for x, _ in rows})
        for v, after in zip(values, values[1:]):
            left = [y for x, y in rows if x[f] <= v]
            right = [y for x, y in rows if x[f] > v]
            score = float(sum(left)) ** 2 / len(left) + float(sum(right)) ** 2 / len(right)
            if best is None or score > best[0]:
                best = score, f, (v + after) / 2
    if best is None:
        return {}
    _, f, threshold = best
    left = [r for r in rows if r[0][f] <= threshold]
    right = [r for r in rows if r[0][f] > threshold]
    return {node: (f, threshold)} | _plain(left, depth - 1, 2 * node) | _plain(right, depth - 1, 2 * node + 1)


def test_tree_equals_the_plain_search(spark):
    draw = random.Random(3)
    rows = [([draw.randint(0, 6) * 1.0, draw.random(), 5.0, draw.choice([-1.5, 2.25])], draw.randint(-40, 90)) for _ in range(150)]
    frame = spark.createDataFrame(rows, "x array<double>, y long")
    tree = grown(frame, ["y"], "y", 4)
    assert {n: (s.feature, s.threshold) for n, s in tree.splits.items()} == _plain(rows, 4)
    assert tree.totals[1] == (150, sum(y for _, y in rows))
    leaves = frame.select(tree.node(F.col("x"), lambda node: node).alias("node")).groupBy("node").count().collect()
    assert all(tree.totals[r.node][0] == r["count"] for r in leaves)


def test_pure_and_constant_nodes_are_leaves(spark):
    same = spark.createDataFrame([([1.0], 5), ([2.0], 5)], "x array<double>, y long")
    assert grown(same, ["y"], "y", 3).splits == {}
    constant = spark.createDataFrame([([1.0], 5), ([1.0], 7)], "x array<double>, y long")
    assert grown(constant, ["y"], "y", 3).splits == {}
    assert grown(same.where("false"), ["y"], "y", 3).totals == {}


def test_classes_split_by_impurity(spark):
    rows = [([float(i % 4), float(i)], int(i >= 6), int(i >= 6), int(i < 6)) for i in range(10)]
    frame = spark.createDataFrame(rows, "x array<double>, label int, a long, b long")
    (split,) = grown(frame, ["a", "b"], "label", 3).splits.values()
    assert (split.feature, split.threshold) == (1, 5.5)


def test_running_totals_within_groups_over_slices(spark):
    rows = [("a" if i % 50 else "b", i, i % 7) for i in range(2000)]
    frame = spark.createDataFrame(rows, "g string, i long, v long")
    got = {(r.g, r.i): r.t for r in with_running_totals_within(frame, ["g"], ["i"], {"v": "t"}).collect()}
    totals = {"a": 0, "b": 0}
    for g, i, v in rows:
        totals[g] += v
        assert got[g, i] == totals[g]

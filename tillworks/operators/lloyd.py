"""K-means whose every step can be checked: Lloyd's rounds from seeds by farthest point.

Coordinates are whole numbers (millionths), so sums do not depend on the order of rows. The first seed is the point with
the smallest key; each further one is the point that is farthest from its nearest seed, the smallest key on ties. So the
seeds for k clusters are the first k, and all wanted k go through the rounds together: one aggregate per round, which
gives no more rows than there are centres. A point belongs to the nearest centre, the first one on ties; a centre that
loses all points stays where it is.

``from_starts`` takes any starts instead, of points in doubles, and ends each of them once none of its centres moves by more
than ``tol``. All starts go through the rounds together there, too: a round reads the points once, however many starts are open.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.session import mapped

UNIT = 1_000_000
ROUNDS = 15

Centre = tuple[float, ...]


def in_millionths(points: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return points.select(F.col(key).alias("key"), F.array(*[F.round(F.col(c) * UNIT).cast("long") for c in columns]).alias("x"))


def _literal(centres: list[Centre]) -> Column:
    return F.array(*[F.array(*[F.lit(v) for v in c]) for c in centres])


def nearest(centres: Column) -> Column:
    """Squared distance ``d`` to the nearest of an array of centres, and its number."""

    def distance(c: Column) -> Column:
        apart = F.zip_with("x", c, lambda a, b: (a - b) * (a - b))
        return F.aggregate(apart, F.lit(0.0), lambda total, v: total + v)

    return F.array_min(F.transform(centres, lambda c, j: F.struct(distance(c).alias("d"), j.alias("cluster"))))


def _for_every_k(points: DataFrame, centres: dict[int, list[Centre]]) -> DataFrame:
    """Points with k and ``near``, once for every k."""
    of = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), _literal(c).alias("centres")) for k, c in centres.items()])).alias("of")
    return points.select("*", of).select("key", "x", "of.k", nearest(F.col("of.centres")).alias("near"))


def seeds(points: DataFrame, k: int) -> list[Centre]:
    """Up to k seeds, fewer where there are fewer different points."""
    found: list[Centre] = []
    first = points.agg(F.min_by("x", "key")).first()[0]
    while first is not None and len(found) < k:
        found.append(tuple(map(float, first)))
        d = nearest(_literal(found))["d"]
        first = points.withColumn("d", d).where("d > 0").agg(F.max_by("x", F.struct("d", -F.col("key")))).first()[0]
    return found


def clustered(points: DataFrame, ks: list[int], rounds: int = ROUNDS) -> dict[int, list[Centre]]:
    """The centres for every k after the rounds; they end early once no centre moves."""
    start = seeds(points, max(ks))
    centres = {k: start[:k] for k in ks}
    sums = [F.sum(F.col("x")[i]) for i in range(len(start[0]))] if start else []
    for _ in range(rounds if start else 0):
        owned = _for_every_k(points, centres).groupBy("k", "near.cluster")
        moved = {k: list(c) for k, c in centres.items()}
        for k, cluster, n, *found in owned.agg(F.count("*"), *sums).collect():
            moved[k][cluster] = tuple(s / n for s in found)
        if moved == centres:
            break
        centres = moved
    return centres


def assigned(points: DataFrame, centres: dict[int, list[Centre]]) -> DataFrame:
    """key, k, cluster and d (squared distance in millionths squared) of every point for every k."""
    if not all(centres.values()):  # no points at all
        return points.select("key", F.lit(0).alias("k"), F.lit(0).alias("cluster"), F.lit(0.0).alias("d"))
    return _for_every_k(points, centres).select("key", "k", "near.cluster", "near.d")


def _owned_by(columns: list[str], starts: dict[int, np.ndarray]):
    """A row per start and centre with points: start, cluster, cost (sum of squared distances), n and the sums by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {i: np.zeros((len(c), 2 + len(columns))) for i, c in starts.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns], axis=1)
            lengths, told = (x * x).sum(axis=1), np.column_stack([np.ones(len(x)), x])
            for i, centres in starts.items():
                # the squared distance less the point's own part, which is the same for all centres
                far = (centres * centres).sum(axis=1)[:, None] - 2 * (centres @ x.T)
                least = far.min(axis=0)
                mine = far == least
                if np.count_nonzero(mine) != len(x):  # ties
                    mine = far.argmin(axis=0) == np.arange(len(centres))[:, None]
                mine = mine.astype(float)
                found[i][:, 0] += mine @ np.maximum(least + lengths, 0)
                found[i][:, 1:] += mine @ told
        rows = [(i, j, *row) for i, sums in found.items() for j, row in enumerate(sums.tolist()) if row[1]]
        names = ["start", "cluster", "cost", "n", *[f"s{j}" for j in range(len(columns))]]
        kinds = [pa.int64(), pa.int64(), *[pa.float64()] * (len(names) - 2)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    return run


def from_starts(points: DataFrame, columns: list[str], starts: list[np.ndarray], rounds: int, tol: float) -> list[tuple[float, np.ndarray]]:
    """Per start (its centres as rows) the cost and the centres after the rounds.

    The cost is that of the last round's points to the centres they had in it, as Spark's own ``KMeans`` tells it.
    """
    plain = points.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sums = [f"s{j}" for j in range(len(columns))]
    schema = ", ".join(["start long, cluster long, cost double, n double", *[f"{s} double" for s in sums]])
    centres, costs = [np.array(c, dtype=float) for c in starts], [0.0] * len(starts)
    going = set(range(len(starts)))
    for _ in range(rounds):
        if not going:
            break
        owned = mapped(plain, _owned_by(columns, {i: centres[i] for i in sorted(going)}), schema).groupBy("start", "cluster")
        told = owned.agg(*[F.sum(c).alias(c) for c in ("cost", "n", *sums)]).collect()  # a row per centre at most
        after, moved = {i: centres[i].copy() for i in going}, set()
        for i in going:
            costs[i] = 0.0
        for i, cluster, cost, n, *found in told:
            costs[i] += cost
            centre = np.array(found) / n
            if ((centre - centres[i][cluster]) ** 2).sum() > tol * tol:
                moved.add(i)
            after[i][cluster] = centre
        for i in going:
            centres[i] = after[i]
        going = moved
    return list(zip(costs, centres))


def labelled(points: DataFrame, columns: list[str], centres: np.ndarray, name: str) -> DataFrame:
    """``points`` with the number of the nearest centre, the first one on ties."""
    rows = points.withColumn("x", F.array(*[F.col(c).cast("double") for c in columns]))
    near = nearest(_literal([tuple(map(float, c)) for c in centres]))
    return rows.withColumn(name, near["cluster"]).drop("x")

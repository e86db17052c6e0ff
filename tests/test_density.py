from __future__ import annotations

import numpy as np
import pytest

from tillworks.operators import components, density
from tillworks.operators.components import connected_components


def brute_force(ids, x, eps, min_points):
    """Reference labels by comparing all pairs, on a small fixture only."""
    order = np.argsort(ids)
    near = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_points
    label = {i: -1 for i in range(len(ids))}
    number = 0
    for start in order:
        if not core[start] or label[start] != -1:
            continue
        stack = [start]
        label[start] = number
        while stack:
            for other in np.nonzero(near[stack.pop()])[0]:
                if label[other] == -1:
                    label[other] = number
                    if core[other]:
                        stack.append(other)
        number += 1
    return {int(ids[i]): label[i] for i in label}


def clustered(seed: int, dimensions: int, n: int):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-4, 4, (5, dimensions))
    x = np.concatenate(
        [centres[i % 5] + rng.normal(0, 0.15 + 0.12 * (i % 5), (n // 6, dimensions)) for i in range(5)]
        + [rng.uniform(-5, 5, (n // 6, dimensions))]
    )
    copies = np.repeat(x[:1], n // 3, axis=0)
    x = np.concatenate([x, copies])
    ids = rng.permutation(len(x)) + 100
    return ids, x


@pytest.mark.parametrize("seed,dimensions,eps,leaf", [(1, 2, 0.25, 32), (2, 3, 0.5, 2), (3, 5, 0.8, 4)])
def test_dbscan_equals_brute_force(spark, monkeypatch, seed, dimensions, eps, leaf):
    """A third of the points are copies; small leaves force several rounds of halving."""
    monkeypatch.setattr(density, "LEAF_POINTS", leaf)
    ids, x = clustered(seed, dimensions, 360)
    columns = [f"c{i}" for i in range(dimensions)]
    rows = [(int(i), *map(float, r)) for i, r in zip(ids, x)]
    frame = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in columns))
    got = {r.id: r.dbscan_cluster for r in density.dbscan(frame, "id", columns, eps, 5).collect()}
    want = brute_force(ids, x, eps, 5)
    assert got == want
    assert len(set(want.values())) > 2 and -1 in want.values()


def test_connected_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(path + star, "u long, v long")
    nodes = spark.createDataFrame([(i,) for i in [*range(1, 41), *range(100, 160), 500]], "u long")
    got = {r.u: r.root for r in connected_components(nodes, edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 500: 500}


def test_candidate_pairs_follow_the_neighbours(spark):
    """Each halving looks at a bounded number of pairs for every pair of cells that are neighbours in the end."""
    ids, x = clustered(4, 3, 900)
    boxes = density._Boxes(3, 0.5)
    frame = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "id long, x array<double>")
    placed = frame.withColumn("cell", boxes.key(0))
    corner = lambda f: density.F.array(*[f(density.F.col("x")[i]) for i in range(3)])
    cells = placed.groupBy("cell").agg(density.F.min("id").alias("cell_id"), corner(density.F.min).alias("lo"), corner(density.F.max).alias("hi"))
    cells = density.stored(cells)
    pairs = density.stored(density._neighbour_cells(cells, boxes))
    found = {frozenset((r.a_cell_id, r.b_cell_id)) for r in pairs.collect()}
    assert len(found) == pairs.count()
    all_cells = cells.collect()
    gap = lambda a, b: sum(max(0, p - q, s - t) ** 2 for p, q, s, t in zip(a.lo, b.hi, b.lo, a.hi))
    want = {frozenset((a.cell_id, b.cell_id)) for a in all_cells for b in all_cells if a.cell_id < b.cell_id and gap(a, b) <= 0.25}
    assert found == want
    level_one = density._coarse(cells, boxes, 1)
    own = density._side(level_one, "a").select("a_box").withColumn("b_box", density.F.col("a_box"))
    upper = pairs.select(*[density.F.transform(c, lambda k: density.F.shiftright(k, 1)).alias(n) for c, n in (("a_cell", "a_box"), ("b_cell", "b_box"))])
    upper = upper.distinct().unionByName(own).distinct()
    assert density._children(upper, density._coarse(cells, boxes, 0)).count() <= 8 * (len(want) + len(all_cells))


def test_a_dense_region_needs_few_pairs_of_cells(spark, monkeypatch):
    """Cells of one part are not compared with each other, and points that are surely core do not ask all their neighbours."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.uniform(0, 1.4, (3000, 5)), rng.uniform(6, 9, (20, 5))])
    asked = []
    for name in ("_link_cells", "_count_neighbours"):

        def counting(points, pairs, *others, run=getattr(density, name)):
            asked.append(pairs.count())
            return run(points, pairs, *others)

        monkeypatch.setattr(density, name, counting)
    frame = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, " + ", ".join(f"c{i} double" for i in range(5)))
    got = {r.id: r.dbscan_cluster for r in density.dbscan(frame, "id", [f"c{i}" for i in range(5)], 0.8, 5).collect()}
    assert got == brute_force(np.arange(len(x)), x, 0.8, 5)
    assert len(asked) == 2 and max(asked) < len(x)


def test_components_of_a_hub_beside_many_small_ones(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(10_000 + 2 * i, 10_001 + 2 * i) for i in range(3000)]
    df = spark.createDataFrame(edges, "u long, v long")
    nodes = df.select("u").union(df.select("v")).distinct().toDF("u")
    roots = connected_components(nodes, df).groupBy("root").count().collect()
    assert {r["count"] for r in roots} == {3000, 2} and len(roots) == 3001


@pytest.mark.parametrize("few_links", [500_000, 0])
def test_components_of_few_and_of_many_links(spark, monkeypatch, few_links):
    """A star, a path and two pairs that meet: one job a round, or with the look-up of nodes with many links."""
    monkeypatch.setattr(components, "FEW_LINKS", few_links)
    links = [*((0, i) for i in range(1, 60)), *((i, i + 1) for i in range(100, 130)), (200, 202), (201, 202)]
    nodes = [*range(60), *range(100, 131), 200, 201, 202, 300]
    found = components.connected_components(spark.createDataFrame([(u,) for u in nodes], "u long"), spark.createDataFrame(links, "u long, v long"))
    assert dict(found.collect()) == {u: 0 if u < 60 else 100 if u < 200 else 200 if u < 300 else 300 for u in nodes}

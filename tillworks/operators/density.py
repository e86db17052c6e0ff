"""Exact DBSCAN without comparing all pairs of a crowded region.

Points fall into cells so small that two points of one cell are always neighbours. A cell with at least
``min_points`` points is therefore all core, and one node of the cluster graph, however many points it
holds. Everything between cells is decided on bounding boxes: two boxes may be wholly within reach, wholly
out of reach, or undecided. Undecided boxes are halved in every dimension and looked at again, and points
are compared one by one only when a box holds few of them. A box of identical points has no extent, so it is
always decided.

Nor are all pairs of neighbouring cells looked at: in five dimensions a cell can have thousands of neighbours. Grids of
coarse cells, each moved by a cell, bring a cell together with some of those around it, at most 2^d and 3^d at a time. That
proves most points to be core, and joins the cells of a region to one part. Only what is left asks all its neighbours: points
not yet proven, and cells for those of another part.
"""

from __future__ import annotations

from functools import reduce
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillworks.operators.components import connected_components
from tillworks.operators.ordering import with_position
from tillworks.session import stored

# Boxes with this many points or fewer are compared point by point.
LEAF_POINTS = 32
# Sides, in cells, of the coarse cells in which neighbours are looked for first.
GRID_SIDES = (2, 3)


def _key(x: Column, width: float) -> Column:
    return F.transform(x, lambda v: F.floor(v / F.lit(width)))


def _parent(key: Column) -> Column:
    return F.transform(key, lambda k: F.shiftright(k, 1))


def _total(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


class _Boxes:
    """Bounding boxes of point sets at one level of the halved grid, and squared distances between them."""

    def __init__(self, dimensions: int, eps: float):
        self.dimensions = dimensions
        self.reach = eps * eps
        # A hair below eps / sqrt(d): rounding must not place two points of a cell out of reach.
        self.side = eps / sqrt(dimensions) * (1 - 1e-9)

    def key(self, level: int) -> Column:
        return _key(F.col("x"), self.side / 2**level)

    def of(self, points: DataFrame, level: int, prefix: str = "") -> DataFrame:
        """Boxes with their key, the key to join on (the parent's below level 0), size and bounds."""
        bounds = [
            F.array(*[f(F.col("x")[i]) for i in range(self.dimensions)]).alias(f"{prefix}{name}")
            for name, f in (("lo", F.min), ("hi", F.max))
        ]
        grouped = points.groupBy(self.key(level).alias(f"{prefix}box")).agg(F.count("*").alias(f"{prefix}size"), *bounds)
        box = F.col(f"{prefix}box")
        return grouped.withColumn(f"{prefix}above", box if level == 0 else _parent(box))

    def nearest(self, a: tuple[str, str], b: tuple[str, str]) -> Column:
        """Squared distance of the two closest points the boxes could hold."""
        (al, ah), (bl, bh) = a, b
        gaps = [
            F.greatest(F.lit(0.0), F.col(al)[i] - F.col(bh)[i], F.col(bl)[i] - F.col(ah)[i])
            for i in range(self.dimensions)
        ]
        return _total([g * g for g in gaps])

    def farthest(self, a: tuple[str, str], b: tuple[str, str]) -> Column:
        """Squared distance of the two most distant points the boxes could hold."""
        (al, ah), (bl, bh) = a, b
        spans = [F.greatest(F.col(ah)[i] - F.col(bl)[i], F.col(bh)[i] - F.col(al)[i]) for i in range(self.dimensions)]
        return _total([s * s for s in spans])

    def within(self, a: str, b: str) -> Column:
        """Whether two points are neighbours."""
        return self.nearest((a, a), (b, b)) <= self.reach


def _coarse(cells: DataFrame, boxes: _Boxes, level: int) -> DataFrame:
    """Boxes of 2^level cells a side: box, above (the box of the next level), bounds, a cell_id for level 0, and the least
    and the most ``mark`` of the cells inside where they have marks."""
    key = F.transform("cell", lambda k: F.shiftright(k, level))
    corners = [
        F.array(*[f(F.col(name)[i]) for i in range(boxes.dimensions)]).alias(name) for name, f in (("lo", F.min), ("hi", F.max))
    ]
    marks = [F.min("mark").alias("least"), F.max("mark").alias("most")] if "mark" in cells.columns else []
    grouped = cells.groupBy(key.alias("box")).agg(F.min("cell_id").alias("cell_id"), *corners, *marks)
    return grouped.withColumn("above", _parent(F.col("box")))


def _side(boxes_of_level: DataFrame, side: str) -> DataFrame:
    return boxes_of_level.select(*[F.col(c).alias(f"{side}_{c}") for c in boxes_of_level.columns])


def _children(pairs: DataFrame, finer: DataFrame) -> DataFrame:
    """Pairs of the boxes inside each pair of boxes; two in one box come in one order, and a box also with itself."""
    joined = pairs.select(F.col("a_box").alias("a_above"), F.col("b_box").alias("b_above"))
    joined = joined.join(_side(finer, "a"), "a_above").join(_side(finer, "b"), "b_above")
    return joined.where((F.col("a_above") != F.col("b_above")) | (F.col("a_box") <= F.col("b_box")))


def _neighbour_cells(cells: DataFrame, boxes: _Boxes, wanted: Column | None = None) -> DataFrame:
    """Unordered pairs of different cells whose boxes come within reach.

    The search begins with boxes so coarse that there are two in each dimension at most, and goes down only into
    pairs of boxes that come within reach: the work follows the pairs that are found. ``wanted`` tells from the marks of
    two boxes (a_least, a_most, b_least, b_most) whether pairs of cells inside can be of use.
    """
    ends = cells.agg(F.min(F.array_min("cell")), F.max(F.array_max("cell"))).first()
    level = 0 if ends[0] is None else int(ends[1] - ends[0]).bit_length()
    top = _coarse(cells, boxes, level).withColumn("above", F.array(F.lit(0).cast("long")))
    pairs = _side(top, "a").join(_side(top, "b"), F.col("a_above") == F.col("b_above")).where("a_box <= b_box")
    close = boxes.nearest(("a_lo", "a_hi"), ("b_lo", "b_hi")) <= boxes.reach
    close = close if wanted is None else close & wanted
    pairs = pairs.where(close)
    while level:
        level -= 1
        pairs = stored(_children(pairs, _coarse(cells, boxes, level)).where(close))
    different = pairs.where(F.col("a_box") != F.col("b_box"))
    return different.select("a_cell_id", F.col("a_box").alias("a_cell"), "b_cell_id", F.col("b_box").alias("b_cell"))


def _in_grids(cells: DataFrame, side: int) -> DataFrame:
    """Each row with ``grid``, once for every grid of coarse cells of ``side`` cells, each moved by a cell from the one before.

    Cells that share a face share a coarse cell of one grid at least.
    """
    moved = [F.struct(F.lit(n).alias("n"), F.transform("cell", lambda k: F.floor((k + n) / side)).alias("box")) for n in range(side)]  # noqa: B023
    return cells.withColumn("grid", F.explode(F.array(*moved)))


def _not_proven(located: DataFrame, cells: DataFrame, boxes: _Boxes, min_points: int) -> DataFrame:
    """Points (id, x, cell) of sparse cells but those that have ``min_points`` neighbours in cells of a coarse cell that are
    wholly within reach."""
    left = located.where(F.col("cell_size") < min_points).select("id", "x", "cell")
    for side in GRID_SIDES:
        near = _in_grids(left, side).drop("cell").join(_in_grids(cells.select("cell", "cell_size", "lo", "hi"), side).drop("cell"), "grid")
        near = near.where(boxes.farthest(("x", "x"), ("lo", "hi")) <= boxes.reach)
        counted = near.groupBy("id", "grid").agg(F.sum("cell_size").alias("n"))
        left = stored(left.join(counted.where(F.col("n") >= min_points).select("id").distinct(), "id", "left_anti"))
    return left


def _parts(nodes: DataFrame, boxes: _Boxes) -> DataFrame:
    """Cells (u) with core points and the ``root`` of the part that one core point of each cell (``x``) joins them to.

    In a coarse cell everything is linked to the least part within its reach. Wider coarse cells are looked at only where they
    hold cells of several parts.
    """
    parts = nodes.select(F.col("cell_id").alias("u"), F.col("cell_id").alias("root"))
    for side in GRID_SIDES:
        placed = _in_grids(nodes.join(parts.withColumnRenamed("u", "cell_id"), "cell_id").select("cell", "x", "root"), side)
        mixed = placed.groupBy("grid").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
        placed = placed.join(mixed.select("grid"), "grid", "left_semi")
        u, v = (placed.select("grid", F.col("root").alias(end), F.col("x").alias(f"{end}x")) for end in ("u", "v"))
        near = u.join(v, "grid").where((F.col("u") < F.col("v")) & boxes.within("ux", "vx"))
        parts = _merged(parts, near.groupBy("grid", "v").agg(F.min("u").alias("u")).select("u", "v").distinct())
    return parts


def _merged(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Parts (u, root) after their roots have been linked."""
    tops = connected_components(parts.select(F.col("root").alias("u")).distinct(), links).withColumnRenamed("u", "part")
    return stored(parts.withColumnRenamed("root", "part").join(tops, "part").select("u", "root"))


def _joined_parts(core: DataFrame, nodes: DataFrame, boxes: _Boxes) -> DataFrame:
    """Cells (u) with core points and the ``root`` of their cluster: parts first, then links between different parts."""
    parts = _parts(nodes, boxes)
    marked = nodes.select("cell", "cell_id", "lo", "hi").join(parts.select(F.col("u").alias("cell_id"), F.col("root").alias("mark")), "cell_id")
    several = F.least("a_least", "b_least") < F.greatest("a_most", "b_most")
    pairs = stored(_neighbour_cells(stored(marked), boxes, several))
    ends = pairs.select(F.explode(F.array("a_cell_id", "b_cell_id")).alias("cell_id")).distinct()
    links = _link_cells(stored(core.join(ends, "cell_id", "left_semi")), pairs, boxes)
    for side in ("u", "v"):
        links = links.withColumnRenamed(side, "cell").join(parts.select(F.col("u").alias("cell"), F.col("root").alias(side)), "cell").drop("cell")
    return _merged(parts, links)


def _count_neighbours(located: DataFrame, pairs: DataFrame, boxes: _Boxes, min_points: int) -> DataFrame:
    """Neighbours outside the own cell for the points that are not ``proven``, as rows (p, cell_id, q, hits).

    Complete for points that stay below ``min_points``; for the others it stops once that number is reached.
    ``q`` is NULL where a dense box was counted as a whole.
    """
    both_ways = pairs.select("a_cell_id", "b_cell_id", "b_cell").unionByName(
        pairs.select(
            F.col("b_cell_id").alias("a_cell_id"), F.col("a_cell_id").alias("b_cell_id"), F.col("a_cell").alias("b_cell")
        )
    )
    asking = located.where(~F.col("proven")).select(
        F.col("id").alias("p"), F.col("x").alias("px"), F.col("cell_size").alias("own"), F.col("cell_id").alias("a_cell_id")
    )
    open_tasks = asking.join(both_ways, "a_cell_id").select(
        "p", "px", "own", F.col("b_cell_id").alias("cell_id"), F.col("b_cell").alias("above")
    )
    found: DataFrame | None = None
    level = 0
    while True:
        judged = open_tasks.join(boxes.of(located, level), "above").drop("above")
        judged = judged.where(boxes.nearest(("px", "px"), ("lo", "hi")) <= boxes.reach)
        whole = (boxes.farthest(("px", "px"), ("lo", "hi")) <= boxes.reach) & (F.col("size") >= min_points)
        judged = stored(judged.withColumn("whole", whole))
        members = located.select(boxes.key(level).alias("box"), F.col("id").alias("q"), F.col("x").alias("qx"))
        few = judged.where(~F.col("whole") & (F.col("size") <= LEAF_POINTS)).join(members, "box")
        hits = judged.where("whole").select(
            "p", "own", "cell_id", F.lit(None).cast("long").alias("q"), F.col("size").alias("hits")
        ).unionByName(
            few.where(boxes.within("px", "qx")).select("p", "own", "cell_id", "q", F.lit(1).cast("long").alias("hits"))
        )
        found = stored(hits if found is None else found.unionByName(hits))
        enough = found.groupBy("p", "own").agg(F.sum("hits").alias("n")).where(F.col("own") + F.col("n") >= min_points)
        open_tasks = stored(
            judged.where(~F.col("whole") & (F.col("size") > LEAF_POINTS))
            .join(enough.select("p"), "p", "left_anti")
            .select("p", "px", "own", "cell_id", F.col("box").alias("above"))
        )
        if open_tasks.isEmpty():
            return found
        level += 1


def _link_cells(core: DataFrame, pairs: DataFrame, boxes: _Boxes) -> DataFrame:
    """Pairs (u, v) of cells that hold core points within reach of each other."""
    nodes = core.select("cell_id").distinct()
    open_tasks = (
        pairs.join(nodes.withColumnRenamed("cell_id", "a_cell_id"), "a_cell_id")
        .join(nodes.withColumnRenamed("cell_id", "b_cell_id"), "b_cell_id")
        .select(
            F.col("a_cell_id").alias("u"),
            F.col("b_cell_id").alias("v"),
            F.col("a_cell").alias("a_above"),
            F.col("b_cell").alias("b_above"),
        )
    )
    linked: DataFrame | None = None
    level = 0
    while True:
        judged = (
            open_tasks.join(boxes.of(core, level, "a_"), "a_above")
            .join(boxes.of(core, level, "b_"), "b_above")
            .where(boxes.nearest(("a_lo", "a_hi"), ("b_lo", "b_hi")) <= boxes.reach)
        )
        whole = boxes.farthest(("a_lo", "a_hi"), ("b_lo", "b_hi")) <= boxes.reach
        judged = stored(judged.withColumn("whole", whole))
        now = judged.where("whole").select("u", "v").distinct()
        rest = judged.where(~F.col("whole")).join(now, ["u", "v"], "left_anti")
        is_few = F.col("a_size") * F.col("b_size") <= LEAF_POINTS * LEAF_POINTS
        a_members = core.select(boxes.key(level).alias("a_box"), F.col("x").alias("ax"))
        b_members = core.select(boxes.key(level).alias("b_box"), F.col("x").alias("bx"))
        few = rest.where(is_few).select("u", "v", "a_box", "b_box").join(a_members, "a_box").join(b_members, "b_box")
        now = now.unionByName(few.where(boxes.within("ax", "bx")).select("u", "v").distinct())
        linked = stored((now if linked is None else linked.unionByName(now)).distinct())
        open_tasks = stored(
            rest.where(~is_few)
            .join(linked, ["u", "v"], "left_anti")
            .select("u", "v", F.col("a_box").alias("a_above"), F.col("b_box").alias("b_above"))
        )
        if open_tasks.isEmpty():
            return linked
        level += 1


def dbscan(
    points: DataFrame, key: str, columns: list[str], eps: float = 0.8, min_points: int = 5, name: str = "dbscan_cluster"
) -> DataFrame:
    """``key`` and cluster number of every point, -1 for noise.

    Clusters are numbered from 0 by the smallest key among their core points; a border point joins the
    lowest-numbered cluster it touches.
    """
    boxes = _Boxes(len(columns), eps)
    placed = points.select(F.col(key).alias("id"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    placed = stored(placed.withColumn("cell", boxes.key(0)))
    bounds = [
        F.array(*[f(F.col("x")[i]) for i in range(boxes.dimensions)]).alias(n) for n, f in (("lo", F.min), ("hi", F.max))
    ]
    cells = stored(
        placed.groupBy("cell").agg(F.min("id").alias("cell_id"), F.count("*").alias("cell_size"), *bounds)
    )
    located = stored(placed.join(cells.select("cell", "cell_id", "cell_size"), "cell"))
    left = _not_proven(located, cells, boxes, min_points).select("id", F.lit(False).alias("asks"))
    proven = (F.col("cell_size") >= min_points) | (F.col("asks").isNull() & F.col("id").isNotNull())
    located = stored(located.join(left, "id", "left").withColumn("proven", proven).drop("asks"))

    asking = located.where(~F.col("proven")).select("cell_id").distinct().withColumn("asks", F.lit(1))
    marked = stored(cells.join(asking, "cell_id", "left").withColumn("mark", F.coalesce("asks", F.lit(0))))
    pairs = stored(_neighbour_cells(marked, boxes, F.greatest("a_most", "b_most") == 1))

    found = _count_neighbours(located, pairs, boxes, min_points)
    counted = found.groupBy("p").agg(F.sum("hits").alias("n")).withColumnRenamed("p", "id")
    neighbours = F.col("cell_size") + F.coalesce("n", F.lit(0))
    is_core = F.col("proven") | (neighbours >= min_points)
    judged = stored(located.join(counted, "id", "left").withColumn("core", is_core).drop("n"))
    core = judged.where("core")

    nodes = stored(core.groupBy("cell", "cell_id").agg(F.min("id").alias("first"), F.min_by("x", "id").alias("x"), *bounds))
    rooted = _joined_parts(core, nodes, boxes).join(nodes.select(F.col("cell_id").alias("u"), "first"), "u")
    roots = rooted.groupBy("root").agg(F.min("first").alias("first"))
    numbered = with_position(roots, ["first"], "position").select(
        "root", (F.col("position") - 1).cast("int").alias("cluster")
    )
    of_cell = stored(rooted.join(numbered, "root").select(F.col("u").alias("cell_id"), "cluster"))

    own = judged.join(of_cell, "cell_id").select("id", "cluster")
    core_ids = core.select(F.col("id").alias("q"))
    outside = judged.where(~F.col("core")).select(F.col("id").alias("p")).join(found, "p")
    by_box = outside.where("q IS NULL").select("p", "cell_id")
    by_point = outside.where("q IS NOT NULL").join(core_ids, "q", "left_semi").select("p", "cell_id")
    touched = by_box.unionByName(by_point).join(of_cell, "cell_id").select(F.col("p").alias("id"), "cluster")
    member = own.unionByName(touched).groupBy("id").agg(F.min("cluster").alias("cluster"))
    return placed.select("id").join(member, "id", "left").select(
        F.col("id").alias(key), F.coalesce("cluster", F.lit(-1)).alias(name)
    )

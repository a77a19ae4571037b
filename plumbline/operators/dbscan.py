"""Density clustering (DBSCAN) on planar points.

Cells have side eps / sqrt(2), so any two points of one cell are neighbours
and only the 20 cells around it can hold others. A cell with at least
`min_points` points is "full": all its points are core. In the other cells
fewer than `min_points` points need a neighbour count, so a point meets a
bounded number of probes however crowded its cell is. Clusters are components
of cells. Whether two full cells touch is decided on their tight boxes, which
are split further only where the boxes leave it open; pairs of points are
formed only between boxes with few of them.

`min_points` counts the point itself and the distance test is inclusive.
Clusters are numbered from 0 by their smallest core id; a border point in reach
of several clusters joins the first of them; noise gets null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.components import connected_components
from plumbline.operators.numbering import number_rows
from plumbline.operators.skew import key_spread, repeat_rows, spread_rows
from plumbline.session import spool

# A little above sqrt(2): the diagonal of a cell stays below eps in spite of rounding.
_ROOT2 = 1.4142136
# Boxes are compared point by point when the product of their counts is at most this.
_PAIR_LIMIT = 1024
# Each refinement halves the boxes this many times per axis.
_HALVINGS = 2

_BOX = ["minx", "miny", "maxx", "maxy"]
# Cells around a cell that can hold a point within eps (all but the four corners of the 5 x 5 block).
_AROUND = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if abs(i) + abs(j) < 4 and (i, j) != (0, 0)]
_HALF_AROUND = [(i, j) for i, j in _AROUND if (i, j) > (0, 0)]


def _box_aggs():
    return [F.min("_x").alias("minx"), F.min("_y").alias("miny"), F.max("_x").alias("maxx"), F.max("_y").alias("maxy")]


def dbscan(
    points: DataFrame,
    *,
    id_col: str,
    x: str = "x",
    y: str = "y",
    eps: float = 20.0,
    min_points: int = 5,
    partition_by: tuple[str, ...] = (),
    name: str = "cluster",
) -> DataFrame:
    """`points` plus `name`, numbered within each `partition_by` group."""
    side = eps / _ROOT2
    cell = ["_part", "_cx", "_cy"]
    part = F.to_json(F.struct(*partition_by), {"ignoreNullFields": "false"}) if partition_by else F.lit("")
    usable = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))
    pts = points.filter(usable).select(
        F.col(id_col).alias("_id"),
        F.col(x).cast("double").alias("_x"),
        F.col(y).cast("double").alias("_y"),
        part.alias("_part"),
        F.floor(F.col(x) / side).alias("_cx"),
        F.floor(F.col(y) / side).alias("_cy"),
    )
    pts = spool(pts, "points")
    cells = spool(pts.groupBy(*cell).agg(F.count("*").alias("n"), *_box_aggs()), "cells")
    hot = key_spread(cells, cell)
    pts = spread_rows(pts, hot, cell, "_id")
    full = F.col("n") >= min_points
    sized = repeat_rows(cells.select(*cell, "n"), hot, cell)
    pts = spool(pts.join(sized, [*cell, "_salt"]).withColumn("_full", full).drop("n"), "points")

    # Neighbour counts of the points in cells that are not full.
    probes = pts.filter("NOT _full").select("_id", "_x", "_y", *cell)
    reach = _reach(probes, pts, hot, cell, eps, _AROUND + [(0, 0)])
    enough = reach.groupBy("_id").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_points).select("_id")
    core = spool(
        pts.join(enough.withColumn("_dense", F.lit(True)), "_id", "left").withColumn(
            "_core", F.col("_full") | F.coalesce("_dense", F.lit(False))
        ).drop("_dense"),
        "flagged",
    )
    core_pts = core.filter("_core")
    cores = core_pts.groupBy(*cell).agg(F.min("_id").alias("_min_id"))

    # Which cells with core points each point of a not-full cell reaches.
    probes = core.filter("NOT _full").select("_id", "_x", "_y", "_core", *cell)
    touch = _reach(probes, core_pts, hot, cell, eps, _AROUND + [(0, 0)], extra=["_core"])
    touch = spool(touch.distinct(), "touch")
    node = F.struct(*cell)
    target = F.struct(F.col("_part"), F.col("_tx").alias("_cx"), F.col("_ty").alias("_cy"))
    links = touch.filter("_core").select(node.alias("src"), target.alias("dst"))
    links = links.union(_full_links(core.filter("_full"), cells.filter(full), hot, cell, eps, side))

    nodes = cores.select(node.alias("node"), "_min_id")
    comp = connected_components(nodes.select("node"), links.distinct())
    firsts = spool(comp.join(nodes, "node"), "components")
    clusters = firsts.groupBy("component").agg(F.min("_min_id").alias("_first"), F.first("node._part").alias("_part"))
    numbered = number_rows(clusters, ["_first"], name, by=["_part"], start=0)
    cell_cluster = spool(
        firsts.select("node", "component").join(numbered.select("component", "_first", name), "component"), "cell_clusters"
    )
    by_cell = cell_cluster.select("node.*", "_first", name)

    # Core points take the cluster of their cell; border points the first cluster they reach.
    of_core = core_pts.join(repeat_rows(by_cell, hot, cell), [*cell, "_salt"]).select("_id", name)
    of_border = (
        touch.filter("NOT _core")
        .join(by_cell.withColumnsRenamed({"_cx": "_tx", "_cy": "_ty"}), ["_part", "_tx", "_ty"])
        .groupBy("_id")
        .agg(F.min_by(name, "_first").alias(name))
    )
    labels = of_core.unionByName(of_border).withColumnRenamed("_id", id_col)
    return points.join(labels, id_col, "left").select(*points.columns, name)


def _reach(probes, targets, hot, cell, eps, around, extra=()):
    """Rows (probe id, its cell, reached cell, extra) for every target point within eps of a probe."""
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in around])
    aimed = probes.withColumn("_o", F.explode(offsets)).select(
        "_part",
        (F.col("_cx") + F.col("_o.i")).alias("_cx"),
        (F.col("_cy") + F.col("_o.j")).alias("_cy"),
        F.col("_cx").alias("_px"),
        F.col("_cy").alias("_py"),
        F.col("_id").alias("_pid"),
        F.col("_x").alias("_ax"),
        F.col("_y").alias("_ay"),
        *extra,
    )
    aimed = repeat_rows(aimed, hot, cell)
    near = targets.select(*cell, "_salt", "_x", "_y").join(aimed, [*cell, "_salt"])
    close = F.pow(F.col("_x") - F.col("_ax"), 2) + F.pow(F.col("_y") - F.col("_ay"), 2) <= eps * eps
    return near.filter(close).select(
        F.col("_pid").alias("_id"),
        "_part",
        F.col("_px").alias("_cx"),
        F.col("_py").alias("_cy"),
        F.col("_cx").alias("_tx"),
        F.col("_cy").alias("_ty"),
        *extra,
    )


def _gap(near: bool) -> str:
    """Squared least (`near`) or greatest distance of the boxes `a` and `b`."""
    if near:
        dx = "greatest(a.minx - b.maxx, b.minx - a.maxx, 0D)"
        dy = "greatest(a.miny - b.maxy, b.miny - a.maxy, 0D)"
    else:
        dx = "greatest(a.maxx - b.minx, b.maxx - a.minx)"
        dy = "greatest(a.maxy - b.miny, b.maxy - a.miny)"
    return f"({dx} * {dx} + {dy} * {dy})"


def _full_links(points, cells, hot, cell, eps, side):
    """Pairs of full cells with two points within eps of each other, as `src, dst`."""
    eps2 = eps * eps
    box = F.struct("n", *_BOX)
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in _HALF_AROUND])
    left = cells.select("_part", "_cx", "_cy", box.alias("a")).withColumn("_o", F.explode(offsets)).select(
        "_part", F.struct(*cell).alias("src"), "a",
        (F.col("_cx") + F.col("_o.i")).alias("_cx"), (F.col("_cy") + F.col("_o.j")).alias("_cy"),
    )
    right = cells.select(*cell, F.struct(*cell).alias("dst"), box.alias("b"))
    pairs = left.join(right, cell).filter(f"{_gap(True)} <= {eps2!r}D")
    pairs = spool(
        pairs.select(
            "src", "dst",
            F.struct(F.col("src._cx").alias("ix"), F.col("src._cy").alias("iy"), F.col("a.n")).alias("a"),
            F.struct(F.col("dst._cx").alias("ix"), F.col("dst._cy").alias("iy"), F.col("b.n")).alias("b"),
            F.expr(f"{_gap(False)} <= {eps2!r}D").alias("sure"),
        ),
        "pairs",
    )
    found = pairs.filter("sure").select("src", "dst")
    level = 0
    unsure = pairs.filter("NOT sure").drop("sure")
    while True:
        few = unsure.filter(F.col("a.n") * F.col("b.n") <= _PAIR_LIMIT)
        found = found.union(_compare_points(few, points, level, side, eps2))
        many = unsure.filter(F.col("a.n") * F.col("b.n") > _PAIR_LIMIT)
        if many.isEmpty():
            return found
        level += _HALVINGS
        pairs = spool(_refine(many, points, level, side, eps2), "pairs")
        known = pairs.filter("sure").select("src", "dst").distinct()
        found = found.union(known)
        unsure = spool(pairs.filter("NOT sure").drop("sure").join(known, ["src", "dst"], "left_anti"), "unsure")


def _at_level(points, level, side):
    """Points with the box they fall in when the cells are halved `level` times."""
    scale = float(2**level)
    return points.select(
        "_part", "_id", "_x", "_y",
        F.floor(F.col("_x") / side * scale).alias("ix"), F.floor(F.col("_y") / side * scale).alias("iy"),
    )


def _compare_points(pairs, points, level, side, eps2):
    """Cell pairs of those box pairs that hold two points within eps."""
    a_key = pairs.select(F.col("src._part").alias("_part"), F.col("a.ix").alias("ix"), F.col("a.iy").alias("iy"))
    b_key = pairs.select(F.col("src._part").alias("_part"), F.col("b.ix").alias("ix"), F.col("b.iy").alias("iy"))
    wanted = a_key.union(b_key).distinct()
    # Every wanted box holds at most _PAIR_LIMIT points.
    lists = (
        _at_level(points, level, side)
        .join(wanted, ["_part", "ix", "iy"], "left_semi")
        .groupBy("_part", "ix", "iy")
        .agg(F.collect_list(F.struct("_x", "_y")).alias("pts"))
    )
    a = lists.select(F.col("_part"), F.col("ix").alias("ax"), F.col("iy").alias("ay"), F.col("pts").alias("pa"))
    b = lists.select(F.col("_part"), F.col("ix").alias("bx"), F.col("iy").alias("by"), F.col("pts").alias("pb"))
    keyed = pairs.select(
        "src", "dst", F.col("src._part").alias("_part"),
        F.col("a.ix").alias("ax"), F.col("a.iy").alias("ay"), F.col("b.ix").alias("bx"), F.col("b.iy").alias("by"),
    )
    close = F.expr(
        "exists(pa, p -> exists(pb, q -> "
        f"(p._x - q._x) * (p._x - q._x) + (p._y - q._y) * (p._y - q._y) <= {eps2!r}D))"
    )
    return keyed.join(a, ["_part", "ax", "ay"]).join(b, ["_part", "bx", "by"]).filter(close).select("src", "dst")


def _refine(pairs, points, level, side, eps2):
    """The box pairs split once more, without those now known to be too far apart."""
    halve = float(2**_HALVINGS)
    coarse = [F.floor(F.col(c) / halve).alias(f"_{c}") for c in ("ix", "iy")]
    keys = [
        pairs.select(F.col("src._part").alias("_part"), F.col(f"{s}.ix").alias("_ix"), F.col(f"{s}.iy").alias("_iy"))
        for s in ("a", "b")
    ]
    boxes = (
        _at_level(points, level, side)
        .groupBy("_part", "ix", "iy")
        .agg(F.count("*").alias("n"), *_box_aggs())
        .select("*", *coarse)
        .join(keys[0].union(keys[1]).distinct(), ["_part", "_ix", "_iy"], "left_semi")
    )
    box = F.struct("ix", "iy", "n", *_BOX)
    a = boxes.select("_part", F.col("_ix").alias("ax"), F.col("_iy").alias("ay"), box.alias("a"))
    b = boxes.select("_part", F.col("_ix").alias("bx"), F.col("_iy").alias("by"), box.alias("b"))
    keyed = pairs.select(
        "src", "dst", F.col("src._part").alias("_part"),
        F.col("a.ix").alias("ax"), F.col("a.iy").alias("ay"), F.col("b.ix").alias("bx"), F.col("b.iy").alias("by"),
    )
    split = keyed.join(a, ["_part", "ax", "ay"]).join(b, ["_part", "bx", "by"])
    return split.filter(f"{_gap(True)} <= {eps2!r}D").select(
        "src", "dst", F.col("a").dropFields(*_BOX).alias("a"), F.col("b").dropFields(*_BOX).alias("b"),
        F.expr(f"{_gap(False)} <= {eps2!r}D").alias("sure"),
    )

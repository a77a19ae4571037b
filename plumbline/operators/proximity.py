"""Boundaries within a distance of points, nearest first, and the k nearest at any distance."""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions.projection import albers, project_rings
from plumbline.operators.grid import BROADCAST_BYTES, CELL, IndexStats, box_cells, cell_size, join_on_cells, zoom
from plumbline.operators.pip import point_in_polygon
from plumbline.session import spool

# Shares of the greatest distance within which `nearest` looks for edges, one after the other.
REACHES = (1 / 32, 1 / 8, 1 / 2, 1)
# How many times as many boundaries `k_nearest` looks at in each of its steps.
SHRINK = 8


def _segment_cells(boundaries: DataFrame, key: str, rings: str, reach: float) -> DataFrame:
    """Edges with the cells their surroundings of width `reach` cover, about 4 x 4 at most."""
    size = cell_size("_z")
    lo = f"floor((least(_e.{{0}}1, _e.{{0}}2) - {reach!r}D) / {size})"
    hi = f"floor((greatest(_e.{{0}}1, _e.{{0}}2) + {reach!r}D) / {size})"
    span = f"greatest(abs(_e.x2 - _e.x1), abs(_e.y2 - _e.y1)) + {2 * reach!r}D"
    return (
        boundaries.select(key, F.explode(F.expr(g.edges(rings))).alias("_e"))
        .withColumn("_z", F.expr(zoom(f"({span})", 3)))
        .withColumn("_cx", F.explode(F.expr(f"sequence({lo.format('x')}, {hi.format('x')})")))
        .withColumn("_cy", F.explode(F.expr(f"sequence({lo.format('y')}, {hi.format('y')})")))
    )


def within_distance(
    points: DataFrame,
    boundaries: DataFrame,
    *,
    id_col: str,
    key: str,
    max_distance: float,
    x: str = "x",
    y: str = "y",
    rings: str = "rings",
    distance: str = "distance_m",
) -> DataFrame:
    """`(id, key, distance)` for every boundary within `max_distance`; 0 inside it. Planar metres."""
    pts = points.select(id_col, x, y)
    near = _edges_near(pts, boundaries, id_col=id_col, key=key, max_distance=max_distance, x=x, y=y, rings=rings, distance=distance)
    inside = point_in_polygon(pts, boundaries.select(key, rings), x=x, y=y, rings=rings, id_col=id_col)
    inside = inside.select(id_col, key, F.lit(0.0).alias(distance))
    return near.unionByName(inside).groupBy(id_col, key).agg(F.min(distance).alias(distance))


def _edges_near(
    pts: DataFrame, boundaries: DataFrame, *, id_col: str, key: str, max_distance: float, x: str, y: str, rings: str, distance: str
) -> DataFrame:
    """`(id, key, distance)` for every edge within `max_distance`."""
    cells = _segment_cells(boundaries, key, rings, max_distance)
    row = cells.agg(F.collect_set("_z").alias("z"), F.count("*").alias("n")).first()
    stats = IndexStats(sorted(row["z"]), row["n"] * 120 <= BROADCAST_BYTES)
    gap = g.segment_distance("b._e", f"p.{x}", f"p.{y}")
    near = join_on_cells(pts, cells, stats, f"{gap} <= {max_distance!r}D", x=x, y=y, id_col=id_col)
    return near.select(F.col(f"p.{id_col}"), F.col(f"b.{key}"), F.expr(gap).alias(distance))


def nearest(
    points: DataFrame, boundaries: DataFrame, *, id_col: str, key: str, max_distance: float, limit: int = 20, **kw
) -> DataFrame:
    """The `limit` nearest boundaries of each point, ties by `key`, with their `rank`.

    Points within enough boundaries need only those with the smallest keys. The others
    look for edges nearby, and again farther out while they have not met enough.
    """
    name, x, y, rings = (kw.get(k, v) for k, v in (("distance", "distance_m"), ("x", "x"), ("y", "y"), ("rings", "rings")))
    pts = spool(points.select(id_col, x, y), "points")
    inside = point_in_polygon(pts, boundaries.select(key, rings), x=x, y=y, rings=rings, id_col=id_col, least=F.col(key), least_count=limit)
    inside = spool(inside.select(id_col, key).distinct().withColumn(name, F.lit(0.0)), "inside")
    found, rest, hits = [], pts, inside
    for share in (None, *REACHES):
        if share is not None:
            near = _edges_near(rest, boundaries, id_col=id_col, key=key, max_distance=max_distance * share, x=x, y=y, rings=rings, distance=name)
            hits = near.unionByName(inside.join(rest.select(id_col).distinct().alias("r"), F.col(f"r.{id_col}").eqNullSafe(inside[id_col]), "left_semi"))
            hits = spool(hits.groupBy(id_col, key).agg(F.min(name).alias(name)), "near")
        if share == 1:
            found.append(hits)
            break
        done = hits.groupBy(id_col).agg(F.count("*").alias("_n")).filter(F.col("_n") >= limit).select(F.col(id_col).alias("_done"))
        of = lambda df, how: df.join(done, df[id_col].eqNullSafe(F.col("_done")), how)
        found.append(of(hits, "left_semi"))
        rest = spool(of(rest, "left_anti"), "rest")
    order = Window.partitionBy(id_col).orderBy(F.col(name), F.col(key))
    hits = functools.reduce(DataFrame.unionByName, found)
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def in_metres(points: DataFrame, boundaries: DataFrame, *, lon: str, lat: str, rings: str = "rings") -> tuple[DataFrame, DataFrame]:
    """Points with `x, y` and boundaries with their rings in the equal-area plane, from longitudes and latitudes."""
    at = F.expr(albers(lon, lat))
    placed = points.withColumn("_at", at).withColumns({"x": F.col("_at.x"), "y": F.col("_at.y")}).drop("_at")
    return placed, boundaries.withColumn(rings, F.expr(project_rings(rings)))


def _closing_radius(points: DataFrame, marks: DataFrame, need: int) -> DataFrame:
    """`points` with `_r`, a distance within which at least `need` of the marks `_vx, _vy` lie.

    Cells of marks are counted together with their eight neighbours. A point whose
    cell has enough is done; the others look again in cells of twice the size.
    """
    ends = [f(c) for c in ("_vx", "_vy") for f in (F.min, F.max)]
    row, own = marks.agg(F.count("*"), *ends).first(), points.agg(*[f(c) for c in ("_x", "_y") for f in (F.min, F.max)]).first()
    if own[0] is None:
        return points.withColumn("_r", F.lit(0.0))
    width = max(row[2] - row[1], row[4] - row[3], 1e-6)
    whole = max(max(row[i + 2], own[i + 1]) - min(row[i + 1], own[i]) for i in (0, 2))
    level = math.ceil(math.log2(width / math.sqrt(max(1.0, row[0] / need))))
    beside = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    done, rest = [], points
    while True:
        size = 2.0**level
        cell = [F.floor(F.col(c) / F.lit(size)) for c in ("_x", "_y")]
        counts = marks.groupBy(*[F.floor(F.col(c) / F.lit(size)).alias(c) for c in ("_vx", "_vy")]).agg(F.count("*").alias("n"))
        around = counts.withColumn("_d", beside).groupBy((F.col("_vx") + F.col("_d.i")).alias("_cx"), (F.col("_vy") + F.col("_d.j")).alias("_cy"))
        met = rest.withColumns({"_cx": cell[0], "_cy": cell[1]}).join(around.agg(F.sum("n").alias("_n")), ["_cx", "_cy"], "left").drop("_cx", "_cy")
        met = spool(met.withColumn("_closed", F.coalesce(F.col("_n") >= need, F.lit(False))).drop("_n"), "reach")
        # The far corner of the neighbours, two cells away along both axes.
        done.append(met.filter("_closed").drop("_closed").withColumn("_r", F.lit(2.0 * math.sqrt(2.0) * size * (1 + 1e-9))))
        rest = met.filter("NOT _closed").drop("_closed")
        if size >= whole or rest.isEmpty():
            return functools.reduce(DataFrame.union, done)
        level += 1


def k_nearest(
    points: DataFrame,
    boundaries: DataFrame,
    *,
    id_col: str,
    key: str,
    limit: int = 20,
    max_distance: float | None = None,
    x: str = "x",
    y: str = "y",
    rings: str = "rings",
    distance: str = "distance_m",
) -> DataFrame:
    """`(id, key, distance, rank)`: the `limit` nearest boundaries of each point however far, ties by `key`.

    Inside a boundary the distance is 0, so points within enough boundaries need
    only the smallest keys of those, however many lie around them. With
    `max_distance` boundaries farther away are left out. For the other points a
    first bound comes from cells around the point that hold corners of enough
    boundaries of a small sample. The k-th nearest of a sample bounds the search
    in one SHRINK times as large, up to all boundaries, so that however dense they
    are a point meets few in each. Boundaries whose boxes lie within the bound are its
    candidates; of these only those whose box is no farther than the k-th smallest
    bound on a distance, from a corner and from the sides of the box, are measured
    exactly. Points without a position and boundaries without a shape take no part.
    """
    shapes = boundaries.filter(F.size(rings) > 0).select(F.col(key), F.col(rings).alias("rings"), F.expr(g.extent(rings)).alias("_box"))
    shapes = shapes.withColumns({"_vx": F.expr("rings[0][0].x"), "_vy": F.expr("rings[0][0].y"), "_b": F.monotonically_increasing_id()})
    shapes = spool(shapes, "shapes")
    pts = points.select(F.col(id_col), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    pts = pts.filter("_x IS NOT NULL AND _y IS NOT NULL AND NOT isnan(_x) AND NOT isnan(_y)")
    pts = spool(pts.withColumn("_p", F.monotonically_increasing_id()), "points")
    many = shapes.count()
    need = min(limit, many)
    if not need:
        return pts.join(shapes, F.lit(False)).select(id_col, key, F.lit(0.0).alias(distance), F.lit(1).alias("rank"))
    point = Window.partitionBy("_p")
    inside = point_in_polygon(
        pts, shapes.select("_b", key, "rings"), x="_x", y="_y", id_col="_p", least=F.struct(F.col(key), F.col("_b")), least_count=need
    )
    first = F.row_number().over(point.orderBy(key, "_b"))
    inside = inside.select("_p", id_col, key, "_b").withColumn("_n", first).filter(F.col("_n") <= need)
    inside = spool(inside, "inside")
    full = inside.filter(F.col("_n") == need).select("_p")
    within = inside.join(full, "_p", "left_semi").select("_p", id_col, key, F.lit(0.0).alias(distance))
    rest = spool(pts.join(full, "_p", "left_anti"), "rest")
    # Each shape is in a sample with one in SHRINK of the shapes of the sample below; the last is all shapes.
    deepest = int(math.log(max(1.0, many / need), SHRINK))
    sample = F.lit(0)
    for n in range(1, deepest + 1):
        sample = F.when(F.pmod(F.xxhash64("_b"), F.lit(SHRINK**n)) == 0, n).otherwise(sample)
    sizes = {r["n"]: r["count"] for r in shapes.groupBy(sample.alias("n")).count().collect()}
    top = max(n for n in range(deepest + 1) if not n or sum(c for m, c in sizes.items() if m >= n) >= 4 * need)
    shapes = shapes.withColumn("_sample", sample)
    reach = _closing_radius(rest, shapes.filter(F.col("_sample") >= top).select("_vx", "_vy"), need)
    for n in range(top, 0, -1):
        # The k-th nearest of a sample is about as near as the k * SHRINK-th of the next one.
        found = _measured(reach, shapes.filter(F.col("_sample") >= n), need).withColumn("_n", F.row_number().over(point.orderBy("_d")))
        near = F.col("_d") * (1 + 1e-9) + F.greatest(F.abs("_x"), F.abs("_y")) * 1e-12
        reach = spool(found.filter(F.col("_n") == need).select("_p", "_x", "_y", near.alias("_r")), "reach")
    found = _measured(reach, shapes, need).join(rest.select("_p", id_col), "_p").join(shapes.select("_b", key), "_b")
    found = found.select("_p", id_col, key, F.col("_d").alias(distance)).unionByName(within)
    if max_distance is not None:
        found = found.filter(F.col(distance) <= max_distance)
    return found.withColumn("rank", F.row_number().over(point.orderBy(distance, key))).filter(F.col("rank") <= limit).drop("_p")


def _measured(reach: DataFrame, shapes: DataFrame, need: int) -> DataFrame:
    """`_p, _x, _y, _b, _d`: the distances of the shapes that can be among the `need` nearest of a point, which lie within `_r`."""
    point = Window.partitionBy("_p")
    box = "named_struct('minx', _x - _r, 'miny', _y - _r, 'maxx', _x + _r, 'maxy', _y + _r)"
    own = F.expr(zoom("greatest(_box.maxx - _box.minx, _box.maxy - _box.miny)", 4))
    boxes_p = spool(reach.withColumn("_box", F.expr(box)).withColumn("_own", own), "boxes")
    boxes_b = shapes.select("_b", "_vx", "_vy", "_box", own.alias("_own"))
    zooms = sorted(r[0] for r in boxes_p.select("_own").union(boxes_b.select("_own")).distinct().collect())

    def cells(df: DataFrame) -> DataFrame:
        return df.withColumn("_c", F.explode(box_cells("_box", "_own", zooms))).select("*", "_c.*").drop("_c")

    # Each pair meets in one cell, that of the lower left corner of what the boxes share.
    size = "pow(2D, p._z)"
    corner = " AND ".join(f"p._c{v} = floor(greatest(p._box.min{v}, b._box.min{v}) / {size})" for v in "xy")
    overlap = " AND ".join(f"p._box.min{v} <= b._box.max{v} AND b._box.min{v} <= p._box.max{v}" for v in "xy")
    meet = F.expr(f"p._z = greatest(p._own, b._own) AND {overlap} AND {corner}")
    for c in CELL:
        meet = (F.col(f"p.{c}") == F.col(f"b.{c}")) & meet
    gap = lambda v: f"greatest(b._box.min{v} - p._{v}, p._{v} - b._box.max{v}, 0D)"
    least = F.expr(f"sqrt(pow({gap('x')}, 2) + pow({gap('y')}, 2))").alias("_least")
    # A shape has a corner on each side of its box, so it is no farther than the far end of the nearer side.
    side = lambda v: f"least(abs(p._{v} - b._box.min{v}), abs(p._{v} - b._box.max{v}))"
    end = lambda v: f"greatest(abs(p._{v} - b._box.min{v}), abs(p._{v} - b._box.max{v}))"
    ends = [f"pow({side(v)}, 2) + pow({end(w)}, 2)" for v, w in ("xy", "yx")]
    most = F.expr(f"sqrt(least(pow(b._vx - p._x, 2) + pow(b._vy - p._y, 2), {', '.join(ends)}))").alias("_most")
    pairs = cells(boxes_p).alias("p").join(cells(boxes_b).alias("b"), meet).select("p._p", "p._x", "p._y", "b._b", least, most)
    pairs = pairs.withColumn("_n", F.row_number().over(point.orderBy("_most", "_b")))
    pairs = pairs.withColumn("_bound", F.max(F.when(F.col("_n") <= need, F.col("_most"))).over(point)).filter("_least <= _bound * (1 + 1e-9)")
    exact = F.expr(g.distance("rings", "_x", "_y")).alias("_d")
    return pairs.join(shapes.select("_b", "rings"), "_b").select("_p", "_x", "_y", "_b", exact)

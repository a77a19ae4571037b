"""Polygon overlay: which boundaries overlap and by how much.

The area of A and B together is a sum over the boundary of the common part
(Green's theorem): the stretches of A's edges inside B plus those of B's edges
inside A. Edges are cut at the grid lines of the other side's cell index, so
every piece meets one cell and its short edge list. No pair of polygons is
formed in advance and each piece is looked at once; pairs appear when the
contributions are summed.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions import measures as m
from plumbline.functions.projection import project_rings
from plumbline.operators.components import connected_components
from plumbline.operators.grid import BROADCAST_BYTES, CELL, box_cells, inside_cell, prepared_index, zoom
from plumbline.operators.skew import key_spread, repeat_rows, spread_rows
from plumbline.session import spool

# Relative width of the strip around an edge that counts as lying on it.
_TOLERANCE = 1e-9
# Zooms between two levels of the quadtree that edges are cut along: a cell holds 8 x 8 of the next.
LEVEL_STEP = 3
# Side of the bins in which ends of one corner meet, against the largest coordinate.
_SNAP = 1e-8


def _grid_cuts(v: str, size: str) -> str:
    """Positions along edge `_e`, within `_t`, where its coordinate `v` passes a grid line."""
    d = f"(_e.{v}2 - _e.{v}1)"
    ends = f"_e.{v}1 + _t.t0 * {d}, _e.{v}1 + _t.t1 * {d}"
    first = f"CAST(floor(least({ends}) / {size}) AS BIGINT)"
    last = f"CAST(ceil(greatest({ends}) / {size}) AS BIGINT)"
    return (
        f"CASE WHEN {d} != 0 THEN filter(transform(sequence({first}, {last}), gc_k -> (gc_k * {size} - _e.{v}1) / {d}), "
        "gc_t -> gc_t > _t.t0 AND gc_t < _t.t1) ELSE CAST(array() AS ARRAY<DOUBLE>) END"
    )


def _cut(pieces: DataFrame, z: int) -> DataFrame:
    """Pieces cut at the grid lines of zoom `z`, each with its cell there."""
    size = f"{2.0**z!r}D"
    cuts = f"array_sort(concat(array(_t.t0, _t.t1), {_grid_cuts('x', size)}, {_grid_cuts('y', size)}))"
    between = (
        "filter(transform(slice(_cuts, 2, size(_cuts)), (pc_t, pc_i) -> "
        "named_struct('t0', _cuts[pc_i], 't1', pc_t)), pc_s -> pc_s.t1 > pc_s.t0)"
    )
    middle = "(_t.t0 + _t.t1) / 2"
    return (
        pieces.withColumn("_cuts", F.expr(cuts))
        .withColumn("_t", F.explode(F.expr(between)))
        .withColumn("_cx", F.expr(f"floor((_e.x1 + {middle} * (_e.x2 - _e.x1)) / {size})"))
        .withColumn("_cy", F.expr(f"floor((_e.y1 + {middle} * (_e.y2 - _e.y1)) / {size})"))
        .drop("_cuts")
    )


def _within(box: dict[str, float]) -> str:
    """The stretch of edge `_e` within a box, as `t0, t1`; null where it stays outside."""
    first, last, outside = ["0D"], ["1D"], []
    for v in "xy":
        d, lo, hi = f"(_e.{v}2 - _e.{v}1)", f"{box['min' + v]!r}D", f"{box['max' + v]!r}D"
        at = f"({lo} - _e.{v}1) / nullif({d}, 0D), ({hi} - _e.{v}1) / nullif({d}, 0D)"
        # Null without a slope, which greatest and least pass over.
        first.append(f"least({at})")
        last.append(f"greatest({at})")
        outside.append(f"greatest(_e.{v}1, _e.{v}2) < {lo} OR least(_e.{v}1, _e.{v}2) > {hi}")
    span = f"named_struct('t0', greatest({', '.join(first)}), 't1', least({', '.join(last)}))"
    return f"CASE WHEN NOT ({' OR '.join(outside)}) THEN {span} END"


@dataclass(frozen=True)
class Occupied:
    """The cells of an index with those that contain them, as a quadtree in rows.

    `cells` has `_z, _cx, _cy`, whether the index has rows there (`_here`) and
    whether it has any in finer cells within (`_below`); `levels` are its zooms
    from one that spans the index in a few cells down to the finest in use.
    """

    cells: DataFrame
    levels: list[int]
    zooms: list[int]
    box: dict[str, float]
    small: bool


def occupied(index: DataFrame, zooms: list[int]) -> Occupied:
    """The quadtree over the cells of a stored index."""
    own = index.select(*CELL).distinct()
    edge = lambda c, extra: f"(_{c} + {extra}) * pow(2D, _z)"
    ends = [F.expr(f"{how}({edge('c' + v, extra)})").alias(how + v) for v in "xy" for how, extra in (("min", 0), ("max", 1))]
    row = own.agg(F.count("*").alias("n"), *ends).first()
    box = {k: row[k] for k in ("minx", "maxx", "miny", "maxy")}
    if not zooms:
        return Occupied(own.select("*", F.lit(True).alias("_here"), F.lit(False).alias("_below")), [], [], box, True)
    top = max(max(zooms), math.ceil(math.log2(max(box["maxx"] - box["minx"], box["maxy"] - box["miny"]))))
    levels = sorted({*zooms, *range(top, min(zooms), -LEVEL_STEP)}, reverse=True)
    above = own.select("_cx", "_cy", F.col("_z").alias("_own"), F.explode(F.array(*[F.lit(z) for z in levels])).alias("_z")).filter("_z >= _own")
    cell = [F.expr(f"shiftright({c}, _z - _own)").alias(c) for c in ("_cx", "_cy")]
    cells = above.select("_z", *cell, "_own").groupBy(*CELL).agg(F.max(F.expr("_z = _own")).alias("_here"), F.max(F.expr("_z > _own")).alias("_below"))
    # A row takes about 40 bytes, and a cell has at most one at each level.
    return Occupied(spool(cells, "occupied"), levels, sorted(zooms), box, row["n"] * len(levels) * 40 <= BROADCAST_BYTES)


def cut_pieces(shapes: DataFrame, keep: list[str], rings: str, tree: Occupied) -> DataFrame:
    """Edges of `shapes` cut to the cells that `tree` has rows in: `keep, _e, _t` and the cell.

    The edges are walked from coarse to fine: a piece is cut further only where its
    cell holds finer ones, so the pieces follow the occupied cells an edge passes
    and not its length. An edge along which nothing is occupied ends at the top.
    """
    pieces = shapes.select(*keep, F.explode(F.expr(g.edges(rings))).alias("_e"))
    pieces = pieces.withColumn("_t", F.expr(_within(tree.box))).filter("_t.t1 > _t.t0")
    found = []
    for z in tree.levels:
        level = tree.cells.filter(F.col("_z") == z)
        met = _cut(pieces, z).join(F.broadcast(level) if tree.small else level, ["_cx", "_cy"])
        if z in tree.zooms and z != tree.levels[-1] or not tree.small:
            # Read twice, or worth counting before the next cut.
            met = spool(met, "pieces")
        if z in tree.zooms:
            found.append(met.filter("_here").select(*keep, "_e", "_t", *CELL))
        pieces = met.filter("_below").select(*keep, "_e", "_t")
    if not found:
        return pieces.select(*keep, "_e", "_t", *[F.lit(0).alias(c) for c in CELL]).limit(0)
    return functools.reduce(DataFrame.union, found)


def _kept(shared_counts: bool) -> str:
    """Stretches `(t0, t1)` of edge `_e` within `_t` that lie inside the other polygon.

    A stretch that runs along an edge of the other polygon counts when both run
    the same way and `shared_counts`, so that it is taken once. Only edges near
    the piece can cut it or run along it; mostly there are none.
    """
    fx, fy = "(kf.x2 - kf.x1)", "(kf.y2 - kf.y1)"
    dx, dy = "(_e.x2 - _e.x1)", "(_e.y2 - _e.y1)"
    width = f"({_TOLERANCE} * greatest(1D, abs({dx}), abs({dy}), abs(_e.x1), abs(_e.y1)))"

    def apart(v, d):
        a, b = f"_e.{v}1 + _t.t0 * {d}", f"_e.{v}1 + _t.t1 * {d}"
        lo, hi = f"least({a}, {b}) - {width}", f"greatest({a}, {b}) + {width}"
        return f"greatest(kf.{v}1, kf.{v}2) < {lo} OR least(kf.{v}1, kf.{v}2) > {hi}"

    near = f"filter(_edges, kf -> NOT ({apart('x', dx)} OR {apart('y', dy)}))"
    den = f"nullif({dx} * {fy} - {dy} * {fx}, 0D)"
    t = f"((kf.x1 - _e.x1) * {fy} - (kf.y1 - _e.y1) * {fx}) / {den}"
    u = f"((kf.x1 - _e.x1) * {dy} - (kf.y1 - _e.y1) * {dx}) / {den}"
    crossings = f"transform(filter(kn, kf -> {u} BETWEEN -{_TOLERANCE} AND 1 + {_TOLERANCE}), kf -> {t})"
    cuts = (
        f"transform(array(array_sort(concat(array(_t.t0, _t.t1), "
        f"filter({crossings}, kt -> kt > _t.t0 AND kt < _t.t1)))), kc -> "
        "filter(transform(slice(kc, 2, size(kc)), (kt, ki) -> named_struct('t0', kc[ki], 't1', kt)), "
        "ks -> ks.t1 > ks.t0))[0]"
    )
    px, py = f"(_e.x1 + (ks.t0 + ks.t1) / 2 * {dx})", f"(_e.y1 + (ks.t0 + ks.t1) / 2 * {dy})"
    same_line = (
        f"abs({dx} * {fy} - {dy} * {fx}) <= 1e-6 * sqrt(({dx} * {dx} + {dy} * {dy}) * ({fx} * {fx} + {fy} * {fy})) "
        f"AND {g.segment_distance('kf', px, py)} <= {width}"
    )
    same_way = f"exists(kn, kf -> {dx} * {fx} + {dy} * {fy} > 0 AND {same_line})"
    on_line = f"exists(kn, kf -> {same_line})"
    inside = inside_cell("", px, py)
    shared = same_way if shared_counts else "false"
    keep = f"CASE WHEN {on_line} THEN {shared} ELSE {inside} END"
    whole_piece = f"CASE WHEN {inside_cell('', px.replace('ks.', '_t.'), py.replace('ks.', '_t.'))} THEN array(_t) ELSE slice(array(_t), 1, 0) END"
    per_near = f"CASE WHEN size(kn) = 0 THEN {whole_piece} ELSE filter({cuts}, ks -> {keep}) END"
    return f"CASE WHEN _whole THEN array(_t) ELSE transform(array({near}), kn -> {per_near})[0] END"


def _inside_stretches(shapes, key, others, other_key, rings, on, shared_counts, splits) -> DataFrame:
    index, stats = prepared_index(others, rings, splits)
    index = spool(index, "cells")
    pieces = cut_pieces(shapes, [key, *on], rings, occupied(index, stats.zooms))
    keys = [*CELL, *on]
    if stats.small:
        # The pieces of one detailed shape leave the task that cut it.
        joined = pieces.repartition(key, *keys).join(F.broadcast(index), keys)
    else:
        # A cell that many pieces pass is spread over several tasks, its rows repeated.
        pieces = spool(pieces, "pieces")
        hot = key_spread(pieces.groupBy(*keys).agg(F.count("*").alias("n")), keys)
        joined = spread_rows(pieces, hot, keys, F.struct(key, "_e", "_t")).join(repeat_rows(index, hot, keys), [*keys, "_salt"])
    return joined.select(key, other_key, *on, "_e", F.expr(_kept(shared_counts)).alias("_in"))


def _stretches(a, b, a_key, b_key, rings, on, splits) -> DataFrame:
    a = a.select(a_key, rings, *on)
    b = b.select(b_key, rings, *on)
    of_a = _inside_stretches(a, a_key, b, b_key, rings, on, True, splits)
    of_b = _inside_stretches(b, b_key, a, a_key, rings, on, False, splits)
    return of_a.unionByName(of_b)


def overlap_areas(
    a: DataFrame,
    b: DataFrame,
    *,
    a_key: str,
    b_key: str,
    rings: str = "rings",
    on: tuple[str, ...] = (),
    splits: int | None = None,
) -> DataFrame:
    """`(a_key, b_key, on..., overlap_area)` of every overlapping pair."""
    return _areas(_stretches(a, b, a_key, b_key, rings, on, splits), [a_key, b_key, *on])


def _areas(parts: DataFrame, keys: list[str]) -> DataFrame:
    share = "aggregate(_in, 0D, (oa_s, oa_t) -> oa_s + oa_t.t1 - oa_t.t0)"
    twice = f"(_e.x1 * _e.y2 - _e.x2 * _e.y1) * {share}"
    sums = parts.groupBy(*keys).agg((F.sum(F.expr(twice)) / 2).alias("overlap_area"))
    return sums.filter(F.col("overlap_area") > 0)


def overlap_geometry(
    a: DataFrame, b: DataFrame, *, a_key: str, b_key: str, rings: str = "rings", on: tuple[str, ...] = (), splits: int | None = None
) -> DataFrame:
    """`(a_key, b_key, on..., rings)`: the common part of each pair."""
    return _shapes(_stretches(a, b, a_key, b_key, rings, on, splits), [a_key, b_key, *on])


def _shapes(parts: DataFrame, keys: list[str]) -> DataFrame:
    """`keys..., rings` from stretches; those of one edge that follow each other are one segment."""
    ends = [
        F.expr(f"_e.{v}1 + _s.{t} * (_e.{v}2 - _e.{v}1)").alias(f"{v}{n}") for n, t in ((1, "t0"), (2, "t1")) for v in "xy"
    ]
    # Cell lines cut an edge where nothing ends; what stays whole is stitched as one.
    stretches = F.array_sort(F.flatten(F.collect_list("_in")))
    joined = (
        "aggregate(_in, CAST(array() AS ARRAY<STRUCT<t0: DOUBLE, t1: DOUBLE>>), (sh_a, sh_s) -> "
        "CASE WHEN size(sh_a) > 0 AND element_at(sh_a, -1).t1 = sh_s.t0 THEN concat(slice(sh_a, 1, size(sh_a) - 1), "
        "array(named_struct('t0', element_at(sh_a, -1).t0, 't1', sh_s.t1))) ELSE concat(sh_a, array(sh_s)) END)"
    )
    edges = parts.groupBy(*keys, "_e").agg(stretches.alias("_in")).withColumn("_s", F.explode(F.expr(joined)))
    return stitched(edges.select(*keys, *ends), keys)


def stitched(segments: DataFrame, keys: list[str]) -> DataFrame:
    """`keys..., rings`: directed segments `x1, y1, x2, y2` joined end to start into closed rings.

    Ends of one corner may differ by rounding: ends in the same or in adjoining
    bins of _SNAP of the group's largest coordinate are one corner. Segments are
    rows throughout; only a group's finished rings meet. Raises ValueError where
    a chain does not close.
    """
    segments = spool(segments.withColumn("_seg", F.monotonically_increasing_id()), "segments")
    largest = F.max(F.greatest(F.lit(1.0), *[F.abs(c) for c in ("x1", "y1", "x2", "y2")]))
    groups = segments.groupBy(*keys).agg(largest.alias("_scale"))
    groups = spool(groups.withColumn("_group", F.monotonically_increasing_id()), "groups")
    named = groups.select(F.col("_group"), F.col("_scale"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same &= segments[k].eqNullSafe(F.col(f"_k{i}"))

    def bin_of(x, y):
        cell = [F.floor(F.col(c) / (_SNAP * F.col("_scale"))) for c in (x, y)]
        return F.struct("_group", cell[0].alias("bx"), cell[1].alias("by"))

    placed = segments.join(named, same).select("_seg", "_group", "x1", "y1", bin_of("x1", "y1").alias("_from"), bin_of("x2", "y2").alias("_to"))
    placed = _cornered(spool(placed, "placed"))
    ends = placed.select(F.col("_from").alias("c"), F.lit(1).alias("n")).union(placed.select(F.col("_to").alias("c"), F.lit(-1).alias("n")))
    open_ends = ends.groupBy("c").agg(F.sum("n").alias("n")).filter("n != 0")
    if broken := open_ends.select("c._group").distinct().count():
        raise ValueError(f"the boundary of the common part does not close in {broken} groups")
    ringed = _ring_places(placed)
    points = F.array_sort(F.collect_list(F.struct("_place", "x1", "y1")))
    rings = ringed.groupBy("_group", "_ring").agg(points.alias("_p")).filter(F.size("_p") > 2)
    closed = "transform(concat(_p, slice(_p, 1, 1)), st_p -> named_struct('x', st_p.x1, 'y', st_p.y1))"
    rings = rings.select("_group", "_ring", F.expr(closed).alias("_points")).groupBy("_group")
    rings = rings.agg(F.array_sort(F.collect_list(F.struct("_ring", "_points"))).alias("_rings"))
    out = groups.join(rings, "_group", "left")
    return out.select(*keys, F.coalesce(F.col("_rings._points"), F.expr(f"CAST(array() AS {g.RINGS})")).alias("rings"))


def _cornered(placed: DataFrame) -> DataFrame:
    """`_from, _to` replaced by one bin for all adjoining ones; segments within a corner go."""
    bins = placed.select(F.col("_from").alias("node")).union(placed.select(F.col("_to").alias("node"))).distinct()
    bins = spool(bins, "bins")
    beside = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((1, 0), (0, 1), (1, 1), (1, -1))]))
    near = bins.withColumn("_d", beside).select(
        F.col("node").alias("src"),
        F.struct("node._group", (F.col("node.bx") + F.col("_d.x")).alias("bx"), (F.col("node.by") + F.col("_d.y")).alias("by")).alias("dst"),
    )
    links = spool(near.join(bins.withColumnRenamed("node", "dst"), "dst", "left_semi").select("src", "dst"), "links")
    linked = links.select(F.col("src").alias("node")).union(links.select("dst")).distinct()
    merged = spool(connected_components(linked, links).filter("node != component"), "corners")
    for end in ("_from", "_to"):
        placed = placed.join(merged.withColumnRenamed("node", end), end, "left")
        placed = placed.withColumn(end, F.coalesce("component", end)).drop("component")
    return spool(placed.filter("_from != _to"), "cornered")


def _ring_places(placed: DataFrame) -> DataFrame:
    """`_group, x1, y1, _ring, _place` of every segment.

    The n-th segment into a corner goes on with the n-th out of it. Places are
    found by doubling: each round, a segment looks twice as far ahead.
    """
    nth = lambda end: F.row_number().over(W.partitionBy(end).orderBy("_seg"))
    into = placed.select("_seg", F.col("_to").alias("c"), nth("_to").alias("n"))
    out = placed.select(F.col("_seg").alias("_next"), F.col("_from").alias("c"), nth("_from").alias("n"))
    follows = spool(into.join(out, ["c", "n"]).select("_seg", "_next"), "follows")
    rings = connected_components(follows.select(F.col("_seg").alias("node")), follows.select(F.col("_seg").alias("src"), F.col("_next").alias("dst")))
    rings = spool(rings.select(F.col("node").alias("_seg"), F.col("component").alias("_ring")), "rings")
    # The ring's first segment is the one that names it.
    ahead = follows.join(rings, "_seg").withColumn("_next", F.expr("CASE WHEN _next != _ring THEN _next END"))
    ahead = spool(ahead.select("_seg", "_next", F.expr("CASE WHEN _next IS NULL THEN 0L ELSE 1L END").alias("_left")), "ahead")
    while not ahead.filter("_next IS NOT NULL").isEmpty():
        then = ahead.select(F.col("_seg").alias("_next"), F.col("_next").alias("_far"), F.col("_left").alias("_more"))
        far = ahead.join(then, "_next", "left")
        ahead = spool(far.select("_seg", F.col("_far").alias("_next"), (F.col("_left") + F.coalesce("_more", F.lit(0))).alias("_left")), "ahead")
    found = placed.join(rings, "_seg").join(ahead.select("_seg", (-F.col("_left")).alias("_place")), "_seg")
    return found.select("_group", "x1", "y1", "_ring", "_place")


def intersection_table(
    source: DataFrame,
    districts: DataFrame,
    *,
    source_type: str,
    rings: str = "rings",
    year: str = "vintage_year",
    state_fips: str | None = None,
    min_overlap: float = 1.0,
    splits: int | None = None,
    projection: str | None = None,
    shape: bool = False,
) -> DataFrame:
    """County or VTD against congressional district overlaps with percents and classes.

    A county pair is dropped when both percents are below `min_overlap`; a VTD
    pair when the VTD's is. `state_fips` restricts the source side only.
    Areas are those of the given plane; with `projection="albers"` the rings are
    longitudes and latitudes, and all is measured in the equal-area plane. With
    `shape` the common part comes along as `intersection_rings`, in that plane.
    """
    if source_type not in ("county", "vtd"):
        raise ValueError("source_type must be county or vtd")
    if state_fips:
        source = source.filter(F.col("geoid").startswith(state_fips))
    src, cd = f"{source_type}_geoid", "cd_geoid"
    plane = F.expr(project_rings(rings, projection)) if projection else F.col(rings)
    a = source.select(F.col("geoid").alias(src), F.col(year).alias("year"), plane.alias("rings"))
    b = districts.select(F.col("geoid").alias(cd), F.col(year).alias("year"), plane.alias("rings"))
    if projection:
        a, b = spool(a, "projected"), spool(b, "projected")
    parts, keys = _stretches(a, b, src, cd, "rings", ("year",), splits), [src, cd, "year"]
    if shape:
        parts = spool(parts, "stretches")
    pairs = _areas(parts, keys)
    whole_a = a.select(src, "year", F.expr(g.area("rings")).alias("_area_a"))
    whole_b = b.select(cd, "year", F.expr(g.area("rings")).alias("_area_b"))
    pct = f"pct_of_{source_type}"
    out = (
        pairs.join(whole_a, [src, "year"])
        .join(whole_b, [cd, "year"])
        # Summing edge terms leaves an error in the last digits; it must not decide a class.
        .withColumn(pct, F.round(m.percent_of("overlap_area", "_area_a"), 9))
        .withColumn("pct_of_cd", F.round(m.percent_of("overlap_area", "_area_b"), 9))
    )
    if source_type == "county":
        out = out.filter(F.greatest(pct, "pct_of_cd") >= min_overlap)
        extra = [m.county_cd_relationship(pct, "pct_of_cd").alias("relationship")]
    else:
        out = out.filter(F.col(pct) >= min_overlap)
        extra = []
    if shape:
        out = spool(out, "overlaps")
        shapes = _shapes(parts.join(out.select(*keys), keys, "left_semi"), keys).withColumnRenamed("rings", "intersection_rings")
        out, extra = out.join(shapes, keys), [*extra, F.col("intersection_rings")]
    return out.select(
        src,
        cd,
        "year",
        F.round("overlap_area", 6).cast("bigint").alias("intersection_area_sqm"),
        F.round(pct, 2).cast("decimal(5,2)").alias(pct),
        F.round("pct_of_cd", 2).cast("decimal(5,2)").alias("pct_of_cd"),
        *extra,
        m.is_dominant(pct).alias("is_dominant"),
    )


def intersecting_pairs(
    a: DataFrame, b: DataFrame, *, a_key: str, b_key: str, rings: str = "rings", splits: int = 4
) -> DataFrame:
    """`(a_key, b_key)` of every pair that shares a place, touching included.

    Extents meet on the grid, each pair in the one cell that holds the lower left
    corner of their common box; the exact test runs on the pairs left.
    """
    zoom_of = zoom("greatest(_box.maxx - _box.minx, _box.maxy - _box.miny)", splits)

    def boxes(df, key):
        out = df.filter(F.size(rings) > 0).select(key, F.expr(g.extent(rings)).alias("_box"))
        return out.withColumn("_own", F.expr(zoom_of))

    boxes_a, boxes_b = boxes(a, a_key), boxes(b, b_key)
    zooms = [r[0] for r in boxes_a.select("_own").union(boxes_b.select("_own")).distinct().collect()]
    if not zooms:
        return a.select(a_key).join(b.select(b_key), F.lit(False))

    def cells(df, key):
        return df.withColumn("_c", F.explode(box_cells("_box", "_own", sorted(zooms)))).select(key, "_box", "_own", "_c.*")

    size = "pow(2D, p._z)"
    meet = F.expr(
        "p._z = greatest(p._own, q._own) AND p._box.minx <= q._box.maxx AND q._box.minx <= p._box.maxx "
        "AND p._box.miny <= q._box.maxy AND q._box.miny <= p._box.maxy "
        f"AND p._cx = floor(greatest(p._box.minx, q._box.minx) / {size}) "
        f"AND p._cy = floor(greatest(p._box.miny, q._box.miny) / {size})"
    )
    for c in CELL:
        meet = (F.col(f"p.{c}") == F.col(f"q.{c}")) & meet
    pairs = cells(boxes_a, a_key).alias("p").join(cells(boxes_b, b_key).alias("q"), meet).select(f"p.{a_key}", f"q.{b_key}")
    shaped = pairs.join(a.select(a_key, F.col(rings).alias("_ra")), a_key).join(b.select(b_key, F.col(rings).alias("_rb")), b_key)
    return shaped.filter(F.expr(g.intersects("_ra", "_rb"))).select(a_key, b_key)

"""A grid of square cells in power-of-two sizes, the join key of spatial joins.

A polygon goes into the zoom where its extent spans about `splits` cells, by
default the square root of its number of edges, so the cells of a polygon grow
with its detail and not with its size; a point is looked up once per zoom in use.

Each cell row carries the edges that touch the cell, and whether its upper right
corner, the anchor, lies inside (`_odd`). A point's own parity follows on the way
to the anchor, to the right as far as the cell's border and up along it: only
edges of the cell can cross that way. Which side of the bend an edge passes is
decided once and used for both legs, so rounding cannot part them, and the
answer equals the ray cast over all edges.

Cells are built from edges as rows. The anchors' parities are running sums of the
edges that cross a column's right border, from the top down; where no edge
touches the cells between two rows of a column, the sum says whether they lie
wholly inside.

Joins that may give many rows a point take the cells cut into slabs (`slabs`): between
two neighbouring corner heights the same edges count for every point, and what the
others add is one bit. With at most SLOTS edges left, they stand in columns of their
own, and the join compares numbers where it would walk through an array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.operators.skew import hot_keys, repeat_rows, spread_rows
from plumbline.session import spool

CELL = ["_z", "_cx", "_cy"]
# Cell sizes from 6e-8 to 1e12; a shape beyond them still works, in fewer or more cells.
MIN_ZOOM, MAX_ZOOM = -24, 40
# Bytes of an index a broadcast side may hold, and those of a row beside its edges and other columns.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 150
# Edges a slab holds as columns, and edges of a cell up to which it is cut into slabs.
SLOTS, SLAB_EDGES = 4, 64
# Probe rows beyond which a large index is joined by sorting.
MANY_PROBES = 100_000
# Bytes of the rows that an edge of a cell adds when the cell is cut into slabs.
SLAB_BYTES = 250
# An edge so close to a cell, against the largest number involved, touches it.
SLACK = 1e-12


def zoom(width: str, splits: int | str) -> str:
    """Power of two of the cell size for an extent of `width` cut into `splits`."""
    level = f"CAST(ceil(log2({width} / CAST({splits} AS DOUBLE))) AS INT)"
    return f"least({MAX_ZOOM}, greatest({MIN_ZOOM}, coalesce({level}, {MIN_ZOOM})))"


def cell_size(z: str) -> str:
    return f"pow(2D, {z})"


def _zoomed(boundaries: DataFrame, rings: str, splits: int | None, keep: list[str]) -> DataFrame:
    """Boundaries with an area, their extent, edges and zoom."""
    fitting = splits or "greatest(3, ceil(sqrt(size(_all))))"
    # Conditions on what a generator gives stay behind it: on the rings themselves they go down to the scan, which
    # then makes the rings once for each mention, in as few tasks as the table has files.
    shape = f"CASE WHEN size({rings}) > 0 THEN array(named_struct('_box', {g.extent(rings)}, '_all', {g.edges(rings)})) END"
    return (
        boundaries.select(*keep, F.explode_outer(F.expr(shape)).alias("_s"))
        .select(*keep, "_s.*")
        .filter("_box.maxx > _box.minx AND _box.maxy > _box.miny")
        .withColumn("_z", F.expr(zoom("greatest(_box.maxx - _box.minx, _box.maxy - _box.miny)", fitting)))
    )


def cell_index(boundaries: DataFrame, rings: str = "rings", splits: int | None = None) -> DataFrame:
    """Cell rows of the boundaries: their other columns plus `_z, _cx, _cy, _whole, _odd, _edges`.

    `_whole` marks a cell that lies wholly inside; cells wholly outside are left out.
    """
    keep = [c for c in boundaries.columns if c != rings]
    return _cells(_stored(_zoomed(boundaries, rings, splits, keep)), keep)


def _stored(zoomed: DataFrame) -> DataFrame:
    """Extents and edges written once, each shape with a number of its own."""
    return spool(zoomed.withColumn("_shape", F.monotonically_increasing_id()), "shapes")


def _exploded(df: DataFrame, name: str, array: str) -> DataFrame:
    """A row for each element; an inner explode has Spark compute the array once more, to leave out empty ones beforehand."""
    return df.withColumn(name, F.explode_outer(F.expr(array))).filter(F.col(name).isNotNull())


def _height(e: str, at: str) -> str:
    """Height at which edge `e` crosses the vertical line through `at`, between its ends."""
    raw = f"({e}.y2 - {e}.y1) * ({at} - {e}.x1) / nullif({e}.x2 - {e}.x1, 0D) + {e}.y1"
    return f"least(greatest({e}.y1, {e}.y2), greatest(least({e}.y1, {e}.y2), {raw}))"


def _touched(edges: DataFrame) -> DataFrame:
    """A row for each edge and cell it touches, a little beyond the cell included."""
    # Columns step by step: as one expression the generated code is too long to be compiled.
    edges = edges.withColumn("_size", F.expr(cell_size("_z")))
    edges = edges.withColumn("_slack", F.expr(f"{SLACK!r}D * greatest(_size, abs(_e.x1), abs(_e.x2), abs(_e.y1), abs(_e.y2))"))
    for v in "xy":
        edges = edges.withColumns({f"_lo{v}": F.expr(f"least(_e.{v}1, _e.{v}2)"), f"_hi{v}": F.expr(f"greatest(_e.{v}1, _e.{v}2)")})
    edges = _exploded(edges, "_cy", "sequence(floor((_loy - _slack) / _size), floor((_hiy + _slack) / _size))")
    # Where the edge enters and leaves the row of cells.
    edges = edges.withColumn("_run", F.expr("(_e.x2 - _e.x1) / nullif(_e.y2 - _e.y1, 0D)"))
    for name, y in (("_low", "_cy * _size - _slack"), ("_high", "(_cy + 1) * _size + _slack")):
        edges = edges.withColumn(name, F.expr(f"(least(_hiy, greatest(_loy, {y})) - _e.y1) * _run + _e.x1"))
    ends = {f"{name}_{end}": F.expr(f"least(_hix, greatest(_lox, coalesce({name}, _{end}x)))") for name in ("_low", "_high") for end in ("lo", "hi")}
    edges = edges.withColumns(ends)
    edges = edges.withColumns({"_first": F.expr("least(_low_lo, _high_lo)"), "_last": F.expr("greatest(_low_hi, _high_hi)")})
    columns = "sequence(floor((_first - _slack) / _size), floor((_last + _slack) / _size))"
    return _exploded(edges, "_cx", columns).select("_shape", "_e", *CELL)


def _cells(zoomed: DataFrame, keep: list[str]) -> DataFrame:
    size = cell_size("_z")
    edges = zoomed.select("_shape", "_z", F.explode("_all").alias("_e"))
    # An edge counts for the right border of a column in the one row where it crosses it.
    border = f"((_cx + 1) * {size})"
    crosses = f"((_e.x1 > {border}) != (_e.x2 > {border}) AND ceil({_height('_e', border)} / {size}) - 1 = _cy)"
    cells = _touched(edges).groupBy("_shape", *CELL).agg(
        F.collect_list("_e").alias("_edges"), F.sum(F.expr(f"CAST({crosses} AS INT)")).alias("_n")
    )
    down = W.partitionBy("_shape", "_z", "_cx").orderBy(F.desc("_cy"))
    above = F.coalesce(F.sum("_n").over(down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumns({"_above": above, "_next": F.lead("_cy").over(down)})
    # Untouched cells below a touched one, down to the next, are inside if the border is.
    inside = "(_above + _n) % 2 = 1 AND _next < _cy - 1"
    below = f"CASE WHEN {inside} THEN sequence(_next + 1, _cy - 1) ELSE CAST(array() AS ARRAY<BIGINT>) END"
    own = "array(named_struct('_cy', _cy, '_whole', false, '_odd', _above % 2 = 1, '_edges', _edges))"
    none = f"CAST(array() AS ARRAY<{g.EDGE}>)"
    whole = f"transform({below}, ce_y -> named_struct('_cy', ce_y, '_whole', true, '_odd', true, '_edges', {none}))"
    rows = _exploded(cells, "_c", f"concat({own}, {whole})").select("_shape", "_z", "_cx", "_c.*")
    return rows.join(zoomed.select("_shape", *keep), "_shape").select(*keep, *CELL, "_whole", "_odd", "_edges")


def smallest_kept(index: DataFrame, least: Column, by: tuple[str, ...] = (), count: int = 1) -> DataFrame:
    """The index rows that can hold one of the `count` smallest `least` around a point, among rows equal in `by`.

    In a cell, what comes in that order after `count` different values of shapes that
    cover the whole cell is never among a point's smallest.
    """
    order = W.partitionBy(*CELL, *by).orderBy("_least", F.desc("_whole"))
    rows = index.withColumn("_least", F.struct(least))
    first = F.col("_whole") & ~F.lag("_least").over(order).eqNullSafe(F.col("_least"))
    rows = rows.withColumn("_new", first.cast("int"))
    before = F.coalesce(F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("_before", before).filter(F.col("_before") < count).drop("_least", "_new", "_before")


def inside_cell(row: str, px: str, py: str) -> str:
    """Whether a point within the cell of index row `row` (a prefix such as `b.`) lies inside its shape."""
    right, top = (f"(({row}_c{v} + 1) * {cell_size(f'{row}_z')})" for v in "xy")
    e = "ic_e"
    along = f"(({e}.x2 - {e}.x1) * ({py} - {e}.y1) / nullif({e}.y2 - {e}.y1, 0D) + {e}.x1)"
    r1, r2, u1, u2 = (f"({e}.{v}{i} > {limit})" for v, limit in (("x", right), ("y", py)) for i in (1, 2))
    # Whether the edge passes beyond the bend, the border at the point's height.
    beyond = f"(CASE WHEN {r1} = {r2} THEN {r1} ELSE {right} < {along} END)"
    rightwards = f"({u1} != {u2} AND {px} < {along} AND NOT {beyond})"
    rising = f"(({e}.x2 > {e}.x1) = ({e}.y2 > {e}.y1))"
    over_bend = f"(CASE WHEN {u1} = {u2} THEN {u1} WHEN {rising} THEN NOT {beyond} ELSE {beyond} END)"
    upwards = f"({r1} != {r2} AND {over_bend} != ({_height(e, right)} > {top}))"
    crossed = f"size(filter({row}_edges, {e} -> {rightwards} != {upwards})) % 2 = 1"
    return f"({row}_whole OR ({crossed}) != {row}_odd)"


def _tangled(edges: str) -> str:
    """Whether a cell with these edges stays whole: too many of them, at one height or in all, or coordinates without end."""
    endless = f"exists({edges}, ta_e -> NOT coalesce(abs(ta_e.x1) + abs(ta_e.x2) + abs(ta_e.y1) + abs(ta_e.y2) < double('Infinity'), false))"
    at = lambda y: f"size(filter({edges}, ta_f -> (ta_f.y1 > {y}) != (ta_f.y2 > {y}))) > {SLOTS}"
    crowded = f"exists({edges}, ta_e -> {at('ta_e.y1')} OR {at('ta_e.y2')})"
    return f"CASE WHEN size({edges}) > {SLAB_EDGES} THEN true WHEN {endless} THEN true WHEN size({edges}) <= {SLOTS} THEN false ELSE {crowded} END"


def tangled(index: DataFrame) -> DataFrame:
    """The index rows that `slabs` leaves out."""
    return index.filter(_tangled("_edges"))


def slabs(index: DataFrame) -> DataFrame:
    """Index rows cut at the heights of their corners, for `inside_slab`; those of `tangled` are left out.

    For a point between `_lo` and `_hi`, `_flip` and each edge in `_e0` and on that
    the point lies to the left of turn the answer over once. The edges follow from
    `inside_cell`: left of the border both ends count by the ray alone; an edge across
    the border counts by the ray as well, for beyond the border it is passed anyway,
    and by a fixed bit that only depends on its place above, below or at the height.
    Slabs that lie wholly outside are left out.
    """
    keep = [c for c in index.columns if c not in ("_whole", "_odd", "_edges")]
    rows = index.filter(f"NOT ({_tangled('_edges')})").withColumn("_size", F.expr(cell_size("_z")))
    rows = rows.withColumns({"_right": F.expr("(_cx + 1) * _size"), "_low": F.expr("_cy * _size"), "_top": F.expr("(_cy + 1) * _size")})
    bend = "((sl_e.x1 > _right) != (sl_e.x2 > _right))"
    rising = "((sl_e.x2 > sl_e.x1) = (sl_e.y2 > sl_e.y1))"
    over = f"({_height('sl_e', '_right')} > _top)"
    own = (
        f"transform(filter(_edges, sl_e -> NOT (sl_e.x1 > _right AND sl_e.x2 > _right)), sl_e -> named_struct('e', sl_e, "
        f"'lo', least(sl_e.y1, sl_e.y2), 'hi', greatest(sl_e.y1, sl_e.y2), "
        f"'at', {bend} AND {rising} != {over}, 'above', {bend} AND NOT {over}, 'below', {bend} AND {over}))"
    )
    rows = rows.withColumn("_own", F.expr(own))
    heights = "concat(transform(_own, sl_o -> sl_o.lo), transform(_own, sl_o -> sl_o.hi))"
    rows = rows.withColumn("_ys", F.expr(f"array_sort(array_distinct(filter({heights}, sl_y -> sl_y > _low AND sl_y < _top)))"))
    cuts = (
        "transform(sequence(0, size(_ys)), sl_i -> named_struct("
        "'lo', coalesce(get(_ys, sl_i - 1), _low), 'hi', coalesce(get(_ys, sl_i), _top), "
        "'first', sl_i = 0, 'last', sl_i = size(_ys)))"
    )
    flips = (
        "aggregate(_own, _odd, (sl_b, sl_o) -> sl_b != CASE WHEN sl_o.lo >= sl_s.hi THEN sl_o.above "
        "WHEN sl_o.hi <= sl_s.lo THEN sl_o.below ELSE sl_o.at END)"
    )
    cut = (
        f"transform({cuts}, sl_s -> named_struct("
        "'_lo', CASE WHEN sl_s.first THEN double('-Infinity') ELSE sl_s.lo END, "
        "'_hi', CASE WHEN sl_s.last THEN double('Infinity') ELSE sl_s.hi END, "
        f"'_flip', {flips}, "
        "'_met', transform(filter(_own, sl_o -> sl_o.lo < sl_s.hi AND sl_o.hi > sl_s.lo), sl_o -> sl_o.e)))"
    )
    none = f"CAST(array() AS ARRAY<{g.EDGE}>)"
    all_in = f"array(named_struct('_lo', double('-Infinity'), '_hi', double('Infinity'), '_flip', true, '_met', {none}))"
    rows = _exploded(rows, "_slab", f"CASE WHEN _whole THEN {all_in} ELSE {cut} END")
    rows = rows.select(*keep, "_slab.*").filter("_flip OR size(_met) > 0")
    return rows.select(*keep, "_lo", "_hi", "_flip", *[F.expr(f"get(_met, {i})").alias(f"_e{i}") for i in range(SLOTS)])


def inside_slab(row: str, px: str, py: str) -> str:
    """Whether a point within the cell of slab row `row` (a prefix such as `b.`) lies inside its shape."""
    turned = f"{row}_flip"
    for i in range(SLOTS):
        e = f"{row}_e{i}"
        left = f"({e} IS NOT NULL AND {px} < ({e}.x2 - {e}.x1) * ({py} - {e}.y1) / ({e}.y2 - {e}.y1) + {e}.x1)"
        turned = f"({turned} != {left})"
    return f"({py} >= {row}_lo AND {py} < {row}_hi AND {turned})"


@dataclass(frozen=True)
class IndexStats:
    zooms: list[int]
    small: bool
    # Whether there may be rows that `slabs` leaves out.
    tangled: bool = True


def row_bytes(columns: list[str]) -> Column:
    """Bytes of an index row without its edges, the columns that came with the shape included."""
    shown = F.struct(*[F.col(c) for c in columns]).cast("string")
    return F.octet_length(shown) + ROW_BYTES


def index_stats(index: DataFrame, limit: int | None = None, edge_bytes: int = 48) -> IndexStats:
    """Zooms in use and whether the index is small enough to broadcast: one aggregate job."""
    row = index.agg(
        F.collect_set("_z").alias("z"),
        F.sum(F.size("_edges") * edge_bytes + row_bytes(index.drop("_edges").columns)).alias("bytes"),
        F.expr(f"bool_or({_tangled('_edges')})").alias("tangled"),
    ).first()
    return IndexStats(sorted(row["z"]), (row["bytes"] or 0) <= (BROADCAST_BYTES if limit is None else limit), bool(row["tangled"]))


@dataclass(frozen=True)
class Shapes:
    """Extents and edges of boundaries, written once, with the measures of the index they give."""

    rows: DataFrame
    keep: list[str]
    zooms: list[int]
    count: int
    # Whether the index is small for sure.
    small: bool
    tangled: bool


def measured_shapes(boundaries: DataFrame, rings: str = "rings", splits: int | None = None, edge_bytes: int = 48) -> Shapes:
    size = cell_size("_z")
    nx = f"(floor(_box.maxx / {size}) - floor(_box.minx / {size}) + 1)"
    ny = f"(floor(_box.maxy / {size}) - floor(_box.miny / {size}) + 1)"
    met = f"aggregate(_all, 0D, (pi_s, pi_e) -> pi_s + (abs(pi_e.x2 - pi_e.x1) + abs(pi_e.y2 - pi_e.y1)) / {size} + 3)"
    keep = [c for c in boundaries.columns if c != rings]
    zoomed = _stored(_zoomed(boundaries, rings, splits, keep))
    held = F.expr(f"{nx} * {ny}") * row_bytes(keep) + F.expr(f"{edge_bytes} * {met}")
    # No cell has more edges at a height than its shape.
    row = zoomed.agg(
        F.collect_set("_z").alias("z"), F.sum(held).alias("bound"), F.expr(f"bool_or({_tangled('_all')})").alias("tangled"), F.count("*").alias("n")
    ).first()
    return Shapes(zoomed, keep, sorted(row["z"]), row["n"], (row["bound"] or 0) <= BROADCAST_BYTES, bool(row["tangled"]))


def prepared_index(
    boundaries: DataFrame | Shapes,
    rings: str = "rings",
    splits: int | None = None,
    reduce: Callable[[DataFrame], DataFrame] | None = None,
    edge_bytes: int = 48,
) -> tuple[DataFrame, IndexStats]:
    """The cell index of the boundaries and its measures.

    Extents and edge lists are written once. A bound on the index size comes from
    them; where it does not settle that the index is small, the index is written
    too and measured, less the rows that `reduce` leaves out.
    """
    if isinstance(boundaries, DataFrame) and "_edges" in boundaries.columns:
        if reduce:
            boundaries = spool(reduce(boundaries), "index")
        return boundaries, index_stats(boundaries, edge_bytes=edge_bytes)
    shapes = boundaries if isinstance(boundaries, Shapes) else measured_shapes(boundaries, rings, splits, edge_bytes)
    index = _cells(shapes.rows, shapes.keep)
    if shapes.small:
        return index, IndexStats(shapes.zooms, True, shapes.tangled)
    index = spool(reduce(index) if reduce else index, "index")
    return index, index_stats(index, edge_bytes=edge_bytes)


def index_within(shapes: DataFrame, keep: list[str], cells: DataFrame | None, on: tuple[str, ...]) -> DataFrame:
    """The index of `shapes`, written once; given `cells`, a short list by `on` and cell, its rows in those cells.

    Shapes whose extent meets none of the cells are not cut.
    """
    if cells is None:
        return spool(_cells(shapes, keep), "index")
    keys = [*on, *CELL]
    cells = F.broadcast(cells.select(*keys))
    size = cell_size("_z")
    slack = f"({SLACK!r}D * greatest({size}, abs(_box.minx), abs(_box.maxx), abs(_box.miny), abs(_box.maxy)))"
    around = shapes.select("_shape", *on, "_z", *[
        F.expr(f"sequence(floor((_box.min{v} - {slack}) / {size}), floor((_box.max{v} + {slack}) / {size}))").alias(f"_c{v}s") for v in "xy"
    ])
    around = _exploded(_exploded(around, "_cx", "_cxs"), "_cy", "_cys")
    met = spool(around.join(cells, keys, "left_semi").select("_shape").distinct(), "met")
    return spool(_cells(shapes.join(met, "_shape", "left_semi"), keep).join(cells, keys, "left_semi"), "index")


def point_cells(x: str, y: str, zooms: list[int]) -> Column:
    """The point's cell at each zoom in use, as an array of structs; null cells for NaN."""
    ok = f"NOT isnan({x}) AND NOT isnan({y})"
    cells = [
        f"named_struct('_z', {z}, '_cx', CASE WHEN {ok} THEN floor({x} / {2.0**z!r}D) END, "
        f"'_cy', CASE WHEN {ok} THEN floor({y} / {2.0**z!r}D) END)"
        for z in zooms
    ]
    return F.expr(f"array({', '.join(cells)})")


def listed_cells(points: DataFrame, x: str, y: str, zooms: str) -> DataFrame:
    """A row for each point and its cell at each zoom listed in its column `zooms`; null cells for NaN."""
    ok = f"NOT isnan({x}) AND NOT isnan({y})"
    rows = points.withColumn("_z", F.explode(zooms))
    return rows.withColumns({f"_c{v}": F.expr(f"CASE WHEN {ok} THEN floor({at} / {cell_size('_z')}) END") for v, at in (("x", x), ("y", y))})


def box_cells(box: str, own_zoom: str, zooms: list[int]) -> Column:
    """Cells of a box at its own zoom and every coarser one in use.

    Two boxes meet exactly at the coarser of their own zooms, so the number of
    cells per box stays bounded at all of them.
    """
    per_zoom = [
        f"CASE WHEN {z} >= {own_zoom} THEN flatten(transform("
        f"sequence(floor({box}.minx / {2.0**z!r}D), floor({box}.maxx / {2.0**z!r}D)), bc_x -> transform("
        f"sequence(floor({box}.miny / {2.0**z!r}D), floor({box}.maxy / {2.0**z!r}D)), bc_y -> "
        f"named_struct('_z', {z}, '_cx', bc_x, '_cy', bc_y)))) "
        f"ELSE CAST(array() AS ARRAY<STRUCT<_z: INT, _cx: BIGINT, _cy: BIGINT>>) END"
        for z in zooms
    ]
    return F.expr(f"flatten(array({', '.join(per_zoom)}))")


def join_on_cells(
    points: DataFrame,
    side: DataFrame,
    stats: IndexStats,
    condition: str,
    *,
    x: str,
    y: str,
    on: tuple[str, ...] = (),
    how: str = "inner",
    id_col: str | None = None,
    zooms: str | None = None,
) -> DataFrame:
    """Points (alias `p`) joined with cell rows (alias `b`) of the same cell where `condition` holds.

    Points are looked up at every zoom in use, or those listed in their column `zooms`.

    A small side is broadcast and the points never move. Otherwise the points per
    cell are counted; those of a crowded cell are spread over several tasks and
    the cell's few rows repeated, so one cell fills no single task. Unless the
    points are few, both sides are sorted by cell.
    """
    keys = [*CELL, *on]
    if zooms:
        probe = listed_cells(points, x, y, zooms)
    elif stats.zooms:
        probe = points.withColumn("_cell", F.explode(point_cells(x, y, stats.zooms)))
    else:
        probe = points.withColumn("_cell", F.expr("named_struct('_z', 0, '_cx', 0L, '_cy', 0L)"))
    if not zooms:
        probe = probe.select(*points.columns, *[F.col(f"_cell.{c}").alias(c) for c in CELL])
    if stats.small:
        side = F.broadcast(side)
    else:
        hot, many = None, True
        if not points.isStreaming:
            counts = probe.groupBy(*keys).agg(F.count("*").alias("n"))
            row = counts.agg(F.sum("n").alias("total"), F.max("n").alias("top")).first()
            hot, many = hot_keys(counts, keys, row["total"], row["top"]), (row["total"] or 0) > MANY_PROBES
        probe = spread_rows(probe, hot, keys, F.col(id_col) if id_col else F.struct(*points.columns))
        side = repeat_rows(side, hot, keys)
        # Sorted, the rows of a cell lie together for all its points; points that seem few by their bytes are not sent to every task.
        side = side.hint("merge") if many else side
        keys = [*keys, "_salt"]
    cond = F.expr(condition)
    for key in keys:
        cond = (F.col(f"p.{key}") == F.col(f"b.{key}")) & cond
    return probe.alias("p").join(side.alias("b"), cond, how)

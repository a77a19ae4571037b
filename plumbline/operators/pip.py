"""Point-in-polygon joins."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.grid import (
    BROADCAST_BYTES,
    CELL,
    MIN_ZOOM,
    SLAB_BYTES,
    IndexStats,
    Shapes,
    index_stats,
    index_within,
    inside_cell,
    inside_slab,
    join_on_cells,
    listed_cells,
    measured_shapes,
    prepared_index,
    row_bytes,
    slabs,
    smallest_kept,
    tangled,
)
from plumbline.session import spool

INDEX_COLUMNS = [*CELL, "_whole", "_odd", "_edges"]
# Rounds of boundaries for the smallest around a point: at least so many in the first, how much they grow, boundaries
# looked at to set their ends, and combinations of columns beyond which there are none.
FIRST_ROUND, GROWTH, CHOICE, MAX_GROUPS = 20_000, 8, 20_000, 64


def shape_columns(boundaries: DataFrame) -> list[str]:
    """The columns that carry the shape: `rings`, or those of a `cell_index`."""
    return INDEX_COLUMNS if "_edges" in boundaries.columns else ["rings"]


def point_in_polygon(
    points: DataFrame,
    boundaries: DataFrame,
    *,
    x: str = "x",
    y: str = "y",
    rings: str = "rings",
    on: tuple[str, ...] = (),
    how: str = "inner",
    id_col: str | None = None,
    first_only: str | None = None,
    splits: int | None = None,
    least: Column | None = None,
    least_by: tuple[str, ...] = (),
    least_count: int = 1,
) -> DataFrame:
    """Points joined with every boundary that contains them.

    `boundaries` has `rings`, or is already a `cell_index`. Columns in `on` must
    be equal on both sides as well. `how="left"` keeps unmatched points and then
    needs `id_col`, a unique point column. `first_only` names a boundary column:
    of several containing boundaries the one with its smallest value wins.

    `least` is for callers that need no more than the `least_count` smallest values
    of it around a point, for each combination of the boundary columns `least_by`:
    boundaries with larger values, or equal ones, may then be missing.

    A small index is broadcast; a large one is joined on the cell, with the
    points of crowded cells spread over several tasks (`grid.join_on_cells`). Cells
    take part as slabs; the few whose edges do not fit them have a join of their own.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be inner or left, not {how!r}")
    if (how == "left" or first_only) and not id_col:
        raise ValueError("left joins and first_only need id_col")
    stored = "_edges" in boundaries.columns
    shapes = boundaries if stored else measured_shapes(boundaries, rings, splits, SLAB_BYTES)
    attrs = [c for c in boundaries.columns if c not in INDEX_COLUMNS and c != rings and c not in on]
    out, direct_left = None, False
    if least is not None and least_count == 1 and not stored and not shapes.small and not points.isStreaming:
        out = _smallest_in_rounds(points, shapes, least, least_by, x=x, y=y, on=on, attrs=attrs)
    if out is None:
        kept = None if least is None else lambda rows: smallest_kept(rows, least, (*on, *least_by), least_count)
        index, stats = prepared_index(shapes, rings, splits, kept, SLAB_BYTES)
        if stats.small and stats.tangled and not stored:
            # Known by the whole shapes only; their cells settle it.
            index = spool(index, "index")
            stats = replace(stats, tangled=index_stats(index).tangled)
        # With one zoom a point has one probe row, so the outer join is direct.
        direct_left = how == "left" and len(stats.zooms) <= 1
        kind = "left" if direct_left else "inner"
        out = _contained(points, index, stats, attrs, x=x, y=y, on=on, how=kind, id_col=id_col)

    if first_only:
        best = out.groupBy(id_col).agg(F.min_by(F.struct(*attrs), first_only).alias("_hit"))
        if how == "left" or len(points.columns) > 1:
            base = points.join(best, id_col, how)
        else:
            base = best
        return base.select(*points.columns, *[F.col(f"_hit.{c}").alias(c) for c in attrs])
    if how == "left" and not direct_left:
        hits = out.select(F.col(id_col), *attrs)
        return points.join(hits, id_col, "left").select(*points.columns, *attrs)
    return out


def _contained(
    points: DataFrame, index: DataFrame, stats: IndexStats, attrs: list[str], *, x: str, y: str, how: str = "inner", **join
) -> DataFrame:
    """Points joined with the shapes of the index that contain them."""

    def joined(side: DataFrame, inside: str) -> DataFrame:
        rows = join_on_cells(points, side, stats, inside, x=x, y=y, how=how, **join)
        return rows.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"b.{c}") for c in attrs])

    whole_cells = inside_cell("b.", f"p.{x}", f"p.{y}")
    if how == "left" and stats.tangled:
        return joined(index, whole_cells)
    cut = slabs(index)
    # Every micro-batch reads them.
    cut = spool(cut, "slabs") if points.isStreaming else cut
    out = joined(cut, inside_slab("b.", f"p.{x}", f"p.{y}"))
    return out.unionAll(joined(tangled(index), whole_cells)) if stats.tangled else out


def _smallest_in_rounds(
    points: DataFrame, shapes: Shapes, least: Column, by: tuple[str, ...], *, x: str, y: str, on: tuple[str, ...], attrs: list[str]
) -> DataFrame | None:
    """Of the boundaries around a point the one with the smallest `least`, for each combination of `by`.

    The boundaries come in rounds by growing `least`, each with GROWTH times as many, so
    a point found in one has its answer and stays out of the next. However many
    boundaries lie over each other, a point thus meets few beyond those it needs, and of
    the later ones only those are cut into cells that lie where points are left, and into
    smaller cells, since such points have many edges around them. None where one round
    would do, or where `by` has too many combinations.
    """
    rounds = 0
    while shapes.count // GROWTH ** (rounds + 1) >= FIRST_ROUND:
        rounds += 1
    rows = shapes.rows.withColumn("_least", F.struct(least))
    if not rounds or rows.groupBy(*by).agg(F.count("*")).limit(MAX_GROUPS + 1).count() > MAX_GROUPS:
        return None
    seen = F.expr(f"pmod(xxhash64(_shape), {max(1, shapes.count // CHOICE)}) = 0")
    groups = rows.groupBy(*by).agg(
        F.collect_set("_z").alias("_zooms"), F.array_sort(F.collect_list(F.when(seen, F.col("_least")))).alias("_seen")
    )
    # Where each round but the last ends.
    ends = [F.expr(f"get(_seen, CAST(size(_seen) / {GROWTH ** (rounds - k)} AS INT))").alias(f"_end{k}") for k in range(rounds)]
    named = [F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]
    groups = spool(groups.select(*named, F.monotonically_increasing_id().alias("_g"), "_zooms", *ends), "groups")
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    rows = rows.join(F.broadcast(groups.drop("_zooms")), same)
    upto = [*[F.coalesce(F.col("_least") <= F.col(f"_end{k}"), F.lit(False)) for k in range(rounds)], F.lit(True)]
    keep, keys = [*shapes.keep, "_g", "_least"], (*on, "_g")
    numbered = spool(points.withColumn("_p", F.monotonically_increasing_id()), "points")
    left = numbered.crossJoin(F.broadcast(groups.select("_g", "_zooms")))
    found = []
    for k in range(rounds + 1):
        cells = None
        if k == 1:
            finer = lambda z: f"greatest({MIN_ZOOM}, {z} - 1)"
            rows = rows.withColumn("_z", F.expr(finer("_z")))
            left = left.withColumn("_zooms", F.expr(f"array_distinct(transform(_zooms, z -> {finer('z')}))"))
        if found:
            left = spool(left.join(found[-1].select("_p", "_g"), ["_p", "_g"], "left_anti"), "left")
            cells = spool(listed_cells(left, x, y, "_zooms").select(*keys, *CELL).distinct(), "cells")
            held = cells.agg(F.sum(row_bytes(cells.columns))).first()[0]
            cells = cells if (held or 0) <= BROADCAST_BYTES else None
        part = rows.filter(upto[k] & ~upto[k - 1] if k else upto[k]).select("_shape", *keep, "_box", "_all", "_z")
        index = index_within(part, keep, cells, keys)
        stats = index_stats(index, edge_bytes=SLAB_BYTES)
        hits = _contained(left, index, stats, [*attrs, "_least"], x=x, y=y, on=keys, id_col="_p", zooms="_zooms")
        best = hits.groupBy("_p", "_g").agg(
            F.first(F.struct(*points.columns)).alias("_point"), F.min_by(F.struct(*attrs), "_least").alias("_hit")
        )
        found.append(spool(best, "found"))
    out = reduce(DataFrame.unionAll, found)
    return out.select(*[F.col(f"_point.{c}").alias(c) for c in points.columns], *[F.col(f"_hit.{c}").alias(c) for c in attrs])


def label_matches_space(
    points: DataFrame, boundaries: DataFrame, *, label: str, name: str, id_col: str, flag: str, **pip
) -> DataFrame:
    """Adds `flag`: whether the boundary with the point's own label contains it."""
    keyed = points.select(id_col, pip.get("x", "x"), pip.get("y", "y"), F.trim(label).alias("_label"))
    shapes = boundaries.select(F.trim(name).alias("_label"), pip.get("rings", "rings"))
    hits = point_in_polygon(keyed, shapes, on=("_label",), id_col=id_col, **pip).select(id_col).distinct()
    return points.join(hits.withColumn(flag, F.lit(True)), id_col, "left").withColumn(
        flag, F.coalesce(flag, F.lit(False))
    )

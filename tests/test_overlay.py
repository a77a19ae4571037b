from dataclasses import replace

import numpy as np
import pytest
from shapes import as_rings, box, inside, star

from plumbline.functions import geometry as g
from plumbline.operators.hull import convex_hulls, enclosing_circle, hull_vertices, reock_scores
from plumbline.operators.grid import prepared_index
from plumbline.operators.overlay import cut_pieces, intersection_table, occupied, overlap_areas, overlap_geometry, stitched
from plumbline.session import spool

A = f"a string, rings {g.RINGS}"
B = f"b string, rings {g.RINGS}"


def frames(spark, a, b):
    return (
        spark.createDataFrame([(k, as_rings(*v)) for k, v in a.items()], A),
        spark.createDataFrame([(k, as_rings(*v)) for k, v in b.items()], B),
    )


def areas(spark, a, b):
    fa, fb = frames(spark, a, b)
    return {(r.a, r.b): r.overlap_area for r in overlap_areas(fa, fb, a_key="a", b_key="b").collect()}


def test_boxes(spark):
    rng = np.random.default_rng(3)
    a, b, expected = {}, {}, {}
    for i in range(12):
        x, y, w, h = rng.uniform(0, 50), rng.uniform(0, 50), rng.uniform(1, 30), rng.uniform(1, 30)
        (a if i % 2 else b)[str(i)] = [box(x, y, x + w, y + h)]
    for i, (p,) in a.items():
        for j, (q,) in b.items():
            w = min(p[2][0], q[2][0]) - max(p[0][0], q[0][0])
            h = min(p[2][1], q[2][1]) - max(p[0][1], q[0][1])
            if w > 0 and h > 0:
                expected[(i, j)] = w * h
    got = areas(spark, a, b)
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(expected[k], rel=1e-9) for k in got)


@pytest.mark.parametrize(
    "a,b,expected",
    [
        (box(0, 0, 4, 4), box(0, 0, 4, 4), 16.0),  # the same box
        (box(0, 0, 4, 4), box(1, 1, 2, 2), 1.0),  # one inside the other
        (box(1, 1, 2, 2), box(0, 0, 4, 4), 1.0),
        (box(0, 0, 4, 4), box(0, 0, 2, 4), 8.0),  # three shared sides
        (box(0, 0, 4, 4), box(4, 0, 8, 4), None),  # a shared side only
        (box(0, 0, 4, 4), box(4, 4, 8, 8), None),  # a shared corner only
        (box(0, 0, 4, 4), box(1, 0, 3, 8), 8.0),  # part of a side shared
        (box(0, 0, 4, 4), box(9, 9, 10, 10), None),
    ],
)
def test_touching_and_nested(spark, a, b, expected):
    got = areas(spark, {"p": [a]}, {"q": [b]})
    assert got == ({} if expected is None else {("p", "q"): pytest.approx(expected, abs=1e-9)})


def test_hole(spark):
    got = areas(spark, {"p": [box(0, 0, 10, 10), box(2, 2, 8, 8)[::-1]]}, {"q": [box(1, 1, 9, 9)]})
    assert got == {("p", "q"): pytest.approx(64 - 36)}


def test_stars_against_sampling(spark):
    rng = np.random.default_rng(11)
    a = {str(i): [star(rng, rng.uniform(0, 10), rng.uniform(0, 10), 8, 25)] for i in range(3)}
    b = {str(i): [star(rng, rng.uniform(0, 10), rng.uniform(0, 10), 8, 25)] for i in range(3)}
    got = areas(spark, a, b)
    grid = [(x + 0.025, y + 0.025) for x in np.arange(-9, 19, 0.1) for y in np.arange(-9, 19, 0.1)]
    for i, (p,) in a.items():
        in_p = [q for q in grid if inside(p, *q)]
        for j, (r,) in b.items():
            sampled = sum(inside(r, *q) for q in in_p) * 0.01
            assert got.get((i, j), 0.0) == pytest.approx(sampled, abs=0.8)


def tree_of(spark, shapes, splits=None):
    _, b = frames(spark, {}, shapes)
    index, stats = prepared_index(b, "rings", splits)
    index = spool(index, "cells")
    return index, occupied(index, stats.zooms)


@pytest.mark.parametrize("small", [True, False])
def test_pieces_follow_the_occupied_cells(spark, small):
    # Seven small boxes along a strip of 2,000 km by 1 km, thousands of their cells apart.
    boxes = {str(i): [box(300_000 * i + 37, 200, 300_000 * i + 737, 800)] for i in range(7)}
    index, tree = tree_of(spark, boxes)
    a, _ = frames(spark, {"strip": [box(-5_000, 0, 2_000_000, 1_000)], "far": [box(0, 9e6, 2e6, 9.1e6)]}, {})
    pieces = cut_pieces(a, ["a"], "rings", replace(tree, small=small)).collect()
    finest = 2.0 ** min(tree.zooms)
    passed = {(r["_z"], r["_cx"], r["_cy"]) for r in pieces}
    held = {(r["_z"], r["_cx"], r["_cy"]) for r in index.collect()}
    assert passed <= held and len(pieces) <= 3 * len(held) < 2 * 2_000_000 / finest / 25
    assert {r["a"] for r in pieces} == {"strip"}
    assert areas(spark, {"strip": [box(-5_000, 0, 2_000_000, 1_000)]}, boxes) == {("strip", k): pytest.approx(700 * 600) for k in boxes}


def test_pieces_cover_an_edge_within_the_cells_once(spark):
    rng = np.random.default_rng(4)
    shapes = {str(i): [star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.choice([0.3, 2, 15]), 30)] for i in range(25)}
    index, tree = tree_of(spark, shapes)
    a, _ = frames(spark, {"a": [star(rng, 0, 0, 50, 40)]}, {})
    pieces = cut_pieces(a, ["a"], "rings", tree).collect()
    assert len(tree.zooms) > 1
    own = {(r["_z"], r["_cx"], r["_cy"]) for r in index.collect()}
    for r in pieces:
        size = 2.0 ** r["_z"]
        middle = (r["_t"]["t0"] + r["_t"]["t1"]) / 2
        x, y = (r["_e"][v + "1"] + middle * (r["_e"][v + "2"] - r["_e"][v + "1"]) for v in "xy")
        assert (x // size, y // size) == (r["_cx"], r["_cy"]) and (r["_z"], r["_cx"], r["_cy"]) in own
    ring = a.first()["rings"][0]
    for z in tree.zooms:
        size = 2.0**z
        for p, q in zip(ring, ring[1:]):
            spans = sorted((r["_t"]["t0"], r["_t"]["t1"]) for r in pieces if r["_z"] == z and (r["_e"]["x1"], r["_e"]["y1"]) == (p["x"], p["y"]))
            assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
            for t in np.linspace(0.0005, 0.9995, 300):
                x, y = p["x"] + t * (q["x"] - p["x"]), p["y"] + t * (q["y"] - p["y"])
                assert ((z, x // size, y // size) in own) == any(s <= t <= e for s, e in spans)


def test_geometry_has_the_area(spark):
    rng = np.random.default_rng(12)
    a = {"0": [star(rng, 0, 0, 8, 20)], "1": [box(0, 0, 10, 10), box(2, 2, 8, 8)[::-1]]}
    b = {"0": [star(rng, 2, 1, 8, 20)], "1": [box(1, 1, 9, 9)]}
    fa, fb = frames(spark, a, b)
    shape = overlap_geometry(fa, fb, a_key="a", b_key="b")
    got = {(r.a, r.b): r.area for r in shape.selectExpr("a", "b", f"{g.area('rings')} area").collect()}
    want = areas(spark, a, b)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-6) for k in got)


def test_geometry_with_corners_between_bins(spark):
    rng = np.random.default_rng(13)
    a, b = {}, {}
    for i in range(300):
        # Sides at half and at whole steps of 1e-8 of the largest coordinate, crossed by slanted ones.
        x, w = (rng.integers(2e7, 4e7, 2) + rng.choice([0, 0.5])) * 1e-7
        a[str(i)] = [box(x, 0, x + w, 10)]
        b[str(i)] = [[(0, 1 + rng.uniform()), (10, 2 + rng.uniform()), (10, 10), (0, 10)]]
        b[str(i)][0].append(b[str(i)][0][0])
    fa, fb = (f.withColumn("k", f[c]) for f, c in zip(frames(spark, a, b), "ab"))
    shape = overlap_geometry(fa, fb, a_key="a", b_key="b", on=("k",))
    got = {r.a: r.area for r in shape.selectExpr("a", f"{g.area('rings')} area").collect()}
    want = {r.a: r.overlap_area for r in overlap_areas(fa, fb, a_key="a", b_key="b", on=("k",)).collect()}
    assert len(got) == 300 and got == {k: pytest.approx(v, rel=1e-6) for k, v in want.items()}


def test_stitching_joins_ends_an_ulp_apart(spark):
    x = 4.0000000499999995
    over, schema = float(np.nextafter(4.00000005, 5)), "k string, x1 double, y1 double, x2 double, y2 double"
    sides = [("p", 0.0, 0.0, x, 0.0), ("p", over, 0.0, x, 1.0), ("p", over, 1.0, 0.0, 1.0), ("p", 0.0, 1.0, 0.0, 0.0)]
    # Two boxes that touch in a corner, of a group without a name.
    rings = [box(c, c, c + 1, c + 1) for c in (0.0, 1.0)]
    sides += [(None, *map(float, (*p, *q))) for ring in rings for p, q in zip(ring, ring[1:])]
    got = {r.k: r.area for r in stitched(spark.createDataFrame(sides, schema), ["k"]).selectExpr("k", f"{g.area('rings')} area").collect()}
    assert got == {"p": pytest.approx(4.00000005), None: pytest.approx(2.0)}
    with pytest.raises(ValueError, match="does not close in 1 groups"):
        stitched(spark.createDataFrame(sides[1:], schema), ["k"])


def test_intersection_table(spark):
    county = [("01001", 2020, as_rings(box(0, 0, 10, 10))), ("01003", 2020, as_rings(box(10, 0, 20, 10)))]
    cds = [("0101", 2020, as_rings(box(-5, -5, 10.05, 15))), ("0102", 2020, as_rings(box(12, 2, 14, 4))), ("0103", 2010, as_rings(box(0, 0, 20, 10)))]
    schema = f"geoid string, vintage_year int, rings {g.RINGS}"
    src, dst = spark.createDataFrame(county, schema), spark.createDataFrame(cds, schema)
    got = {(r.county_geoid, r.cd_geoid): r for r in intersection_table(src, dst, source_type="county").collect()}
    assert set(got) == {("01001", "0101"), ("01003", "0102")}
    assert got["01001", "0101"].relationship == "COUNTY_IN_CD" and got["01001", "0101"].is_dominant
    assert got["01003", "0102"].relationship == "CD_IN_COUNTY" and not got["01003", "0102"].is_dominant
    assert float(got["01003", "0102"].pct_of_county) == 4.0 and got["01003", "0102"].intersection_area_sqm == 4
    vtd = intersection_table(src, dst, source_type="vtd", state_fips="01", min_overlap=5.0).collect()
    assert {(r.vtd_geoid, r.cd_geoid) for r in vtd} == {("01001", "0101")}


def test_hulls(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), float(x), float(y)) for k, x, y in zip(rng.integers(0, 4, 900), rng.normal(size=900), rng.normal(size=900))]
    rows += [(9, 1.0, 1.0), (9, 1.0, 1.0), (8, 0.0, 0.0), (8, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k long, x double, y double").repartition(6)
    got = {r.k: [(p.x, p.y) for p in r.rings[0]] for r in convex_hulls(df, ["k"]).collect()}
    assert set(got) == {0, 1, 2, 3, 8, 9}
    for k in range(4):
        xy = np.array([(x, y) for kk, x, y in rows if kk == k])
        assert got[k][:-1] == [tuple(p) for p in hull_vertices(xy)]
        ring = np.array(got[k])
        side = [((q - p)[0] * (xy - p)[:, 1] - (q - p)[1] * (xy - p)[:, 0]).min() for p, q in zip(ring, ring[1:])]
        assert min(side) > -1e-9
    assert got[9] == [(1.0, 1.0), (1.0, 1.0)]


def test_circle_and_reock(spark):
    rng = np.random.default_rng(6)
    for _ in range(20):
        xy = rng.normal(size=(15, 2))
        cx, cy, r = enclosing_circle(xy)
        d = np.hypot(xy[:, 0] - cx, xy[:, 1] - cy)
        assert d.max() <= r * (1 + 1e-9) and (np.abs(d - r) < 1e-7).sum() >= 2
    df = spark.createDataFrame([("sq", as_rings(box(0, 0, 2, 2)))], f"d string, rings {g.RINGS}")
    assert reock_scores(df, "d").first().reock == pytest.approx(2 / np.pi)

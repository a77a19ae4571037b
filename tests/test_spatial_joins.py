import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from shapes import as_rings, box, inside, segment_distance, star

from plumbline.functions import geometry as g
from plumbline.operators import grid, pip, proximity, skew
from plumbline.operators.pip import label_matches_space, point_in_polygon
from plumbline.operators.proximity import k_nearest, nearest, within_distance
from plumbline.sources.boundaries import with_rings

SCHEMA = f"geoid string, name string, rings {g.RINGS}"


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(7)
    shapes = {}
    for i in range(30):
        # Sizes from 0.5 to 60 put the shapes into several zooms.
        r = float(rng.choice([0.5, 3, 15, 60]))
        shapes[f"{i:03d}"] = star(rng, rng.uniform(-100, 100), rng.uniform(-60, 60), r, int(rng.integers(4, 40)))
    rows = [(k, f"n{k}", as_rings(v)) for k, v in shapes.items()]
    pts = pd.DataFrame({"id": range(600), "x": rng.uniform(-120, 120, 600), "y": rng.uniform(-80, 80, 600)})
    # A third of the points share one place.
    pts.loc[:200, ["x", "y"]] = [float(shapes["000"][0][0]) - 0.01, float(shapes["000"][0][1]) - 0.01]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(pts), shapes, pts


def want(shapes, pts):
    return {(int(r.id), k) for r in pts.itertuples() for k, ring in shapes.items() if inside(ring, r.x, r.y)}


def test_same_as_ray_cast(world):
    polys, points, shapes, pts = world
    got = point_in_polygon(points, polys).select("id", "geoid").collect()
    assert len(got) == len(set(got))
    assert {(r.id, r.geoid) for r in got} == want(shapes, pts)


def test_large_index_takes_the_spread_join(world, monkeypatch):
    polys, points, shapes, pts = world
    monkeypatch.setattr(grid, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    index, stats = grid.prepared_index(polys)
    assert not stats.small
    probe = points.selectExpr("x", "y").withColumn("_c", F.explode(grid.point_cells("x", "y", stats.zooms))).select("_c.*")
    assert skew.key_spread(probe.groupBy(grid.CELL).agg(F.count("*").alias("n")), grid.CELL).count() > 0
    got = point_in_polygon(points, index, id_col="id").select("id", "geoid").collect()
    assert len(got) == len(set(got))
    assert {(r.id, r.geoid) for r in got} == want(shapes, pts)


def test_left_keeps_every_point_and_first_takes_the_smallest(world):
    polys, points, shapes, pts = world
    expected = {}
    for i, k in want(shapes, pts):
        expected.setdefault(i, set()).add(k)
    left = point_in_polygon(points, polys, how="left", id_col="id").select("id", "geoid").collect()
    assert {r.id for r in left} == set(range(600))
    assert {(r.id, r.geoid) for r in left if r.geoid} == want(shapes, pts)
    assert all(r.geoid is None for r in left if r.id not in expected)
    first = point_in_polygon(points, polys, how="left", id_col="id", first_only="geoid").collect()
    assert {r.id: r.geoid for r in first} == {i: min(expected[i]) if i in expected else None for i in range(600)}


def test_single_zoom_left_join(spark):
    polys = spark.createDataFrame([("a", "A", as_rings(box(0, 0, 1, 1))), ("b", "B", as_rings(box(1, 0, 2, 1)))], SCHEMA)
    rows = [(1, 0.5, 0.5), (2, 1.0, 0.5), (3, 9.0, 9.0), (4, None, 0.5), (5, float("nan"), 0.5)]
    points = spark.createDataFrame(rows, "id long, x double, y double")
    got = point_in_polygon(points, polys, how="left", id_col="id").collect()
    # A point on the shared edge belongs to exactly one side.
    assert {r.id: r.geoid for r in got} == {1: "a", 2: "b", 3: None, 4: None, 5: None}
    assert len(got) == 5


def test_holes_and_parts(spark):
    rings = as_rings(box(0, 0, 10, 10), box(2, 2, 4, 4)[::-1], box(20, 0, 30, 10))
    polys = spark.createDataFrame([("a", "A", rings)], SCHEMA)
    points = spark.createDataFrame([(1, 3.0, 3.0), (2, 5.0, 5.0), (3, 25.0, 5.0), (4, 15.0, 5.0)], "id long, x double, y double")
    assert {r.id for r in point_in_polygon(points, polys).collect()} == {2, 3}


def test_shapes_without_area_hold_nothing(spark):
    flat = [(0.0, 0.0), (4.0, 0.0), (2.0, 0.0), (0.0, 0.0)]
    polys = spark.createDataFrame([("a", "A", as_rings(flat)), ("b", "B", as_rings([(1, 1), (1, 1)])), ("c", "C", []), ("d", "D", None)], SCHEMA)
    points = spark.createDataFrame([(1, 1.0, 0.0), (2, 1.0, 1.0)], "id long, x double, y double")
    assert point_in_polygon(points, polys).count() == 0


def test_empty_boundaries(spark, world):
    _, points, _, _ = world
    none = spark.createDataFrame([], SCHEMA)
    assert point_in_polygon(points, none).count() == 0
    assert point_in_polygon(points, none, how="left", id_col="id").count() == 600


def test_label_matches_space(spark):
    polys = spark.createDataFrame([("1", "VA ", as_rings(box(0, 0, 1, 1))), ("2", "NC", as_rings(box(5, 5, 6, 6)))], SCHEMA)
    points = spark.createDataFrame(
        [(1, " VA", 0.5, 0.5), (2, "NC", 0.5, 0.5), (3, "VA", 7.0, 7.0), (4, None, 0.5, 0.5)],
        "id long, state string, x double, y double",
    )
    got = label_matches_space(points, polys, label="state", name="name", id_col="id", flag="ok").collect()
    assert {r.id: r.ok for r in got} == {1: True, 2: False, 3: False, 4: False}


def test_within_distance(world):
    polys, points, shapes, pts = world
    some = points.filter("id % 10 = 0")
    got = {(r.id, r.geoid): r.distance_m for r in within_distance(some, polys, id_col="id", key="geoid", max_distance=12.0).collect()}
    expected = {}
    for r in pts[pts.id % 10 == 0].itertuples():
        for k, ring in shapes.items():
            d = 0.0 if inside(ring, r.x, r.y) else segment_distance(ring, r.x, r.y)
            if d <= 12.0:
                expected[(int(r.id), k)] = d
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)


def test_nearest_keeps_the_first_k(world):
    polys, points, _, _ = world
    some = points.filter("id % 10 = 0")
    full = within_distance(some, polys, id_col="id", key="geoid", max_distance=40.0).toPandas()
    top = nearest(some, polys, id_col="id", key="geoid", max_distance=40.0, limit=3).toPandas()
    full = full.sort_values(["id", "distance_m", "geoid"]).groupby("id").head(3)
    assert set(zip(top.id, top.geoid)) == set(zip(full.id, full.geoid))


@pytest.mark.parametrize("limit, most", [(1, None), (4, None), (50, None), (4, 15.0)])
def test_k_nearest_without_a_radius(spark, world, limit, most):
    polys, _, shapes, pts = world
    # Crowded, far away and without a place.
    rows = [(int(r.id), float(r.x), float(r.y)) for r in pts[pts.id % 20 == 0].itertuples()]
    rows += [(1000, 5e4, -3e5), (1001, None, 0.0), (1002, float("nan"), 1.0), (1003, 0.0, 0.0), (1003, 0.0, 0.0)]
    points = spark.createDataFrame(rows, "id long, x double, y double")
    empty = spark.createDataFrame([("no", "n", []), ("none", "n", None)], SCHEMA)
    got = k_nearest(points, polys.union(empty), id_col="id", key="geoid", limit=limit, max_distance=most).collect()
    want = []
    for i, x, y in rows:
        if x is None or np.isnan(x):
            continue
        found = sorted((0.0 if inside(ring, x, y) else segment_distance(ring, x, y), k) for k, ring in shapes.items())
        want += [(i, k, r + 1, d) for r, (d, k) in enumerate(found[:limit]) if most is None or d <= most]
    got, want = sorted((r["id"], r["geoid"], r["rank"], r["distance_m"]) for r in got), sorted(want)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(g[3] == pytest.approx(w[3], rel=1e-9, abs=1e-9) for g, w in zip(got, want))


def test_k_nearest_of_nothing(spark, world):
    polys, points, _, _ = world
    assert k_nearest(points, polys.limit(0), id_col="id", key="geoid").count() == 0
    assert k_nearest(points.limit(0), polys, id_col="id", key="geoid").count() == 0


def test_cells_carry_less_than_all_edges(world):
    polys, _, _, _ = world
    index = grid.cell_index(polys)
    whole = index.filter("_whole").agg(F.max(F.size("_edges"))).first()[0]
    assert whole == 0


def circle(n, radius=100.0):
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    ring = list(zip((radius * np.cos(angle)).tolist(), (radius * np.sin(angle)).tolist()))
    return [*ring, ring[0]]


def test_cells_of_detailed_polygons_stay_short(spark):
    """The fullest cell holds less than twice the square root of the edges."""
    for n in (400, 20_000):
        rows = spark.createDataFrame([("c", as_rings(circle(n)))], f"geoid string, rings {g.RINGS}")
        index = grid.cell_index(rows)
        edges = index.agg(F.max(F.size("_edges")).alias("most"), F.sum(F.size("_edges")).alias("all")).first()
        assert edges["most"] < 2 * n**0.5
        assert edges["all"] < 3 * n


def snapped(rng, n, step):
    """A star whose corners lie on a lattice, so that edges run along and end on cell lines."""
    ring = [(round(x / step) * step, round(y / step) * step) for x, y in star(rng, 0, 0, 40, n)[:-1]]
    ring = [p for p, q in zip(ring, [*ring[1:], ring[0]]) if p != q]
    return [*ring, ring[0]]


@pytest.mark.parametrize("step, shift", [(1.0, 0.0), (4.0, 0.0), (0.5, 1e7), (1e-3, 0.3)])
def test_anchored_cells_agree_with_the_full_ray_cast(spark, step, shift):
    rng = np.random.default_rng(int(step * 1000))
    rows, places = [], []
    for i in range(12):
        outer, inner = snapped(rng, int(rng.integers(5, 60)), step), snapped(rng, 6, step)
        rings = [[(x + shift, y - shift) for x, y in outer], [(x / 8 + shift, y / 8 - shift) for x, y in inner][::-1]]
        rows.append((f"{i}", as_rings(*rings)))
        corners = rings[0] + rings[1]
        places += corners + [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for a, b in zip(corners, corners[1:])]
    lattice = [(x * 2.0 + shift, y * 2.0 - shift) for x in range(-22, 23) for y in range(-22, 23)]
    places += lattice + [(x + shift, y - shift) for x, y in rng.uniform(-45, 45, (1500, 2))]
    polys = spark.createDataFrame(rows, f"geoid string, rings {g.RINGS}")
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places)], "id long, x double, y double")
    want = points.crossJoin(polys).filter(F.expr(g.contains("rings", "x", "y"))).select("id", "geoid").collect()
    for splits in (None, 3, 40):
        got = point_in_polygon(points, polys, splits=splits).select("id", "geoid").collect()
        assert len(got) == len(set(got)) and set(got) == set(want)


def _stacked(n):
    """Squares that all cover much of the same ground, keys in no order of place."""
    out = []
    for i in range(n):
        x, y, r = (i * 37 % 23) / 10, (i * 53 % 19) / 10, 6 + i % 5
        corners = [(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r), (x - r, y - r)]
        out.append((f"k{i * 7919 % n:04d}", x, y, float(r), [[{"x": a, "y": b} for a, b in corners]]))
    return out


def test_only_shapes_that_may_be_smallest_stay_in_a_cell(spark):
    rows = _stacked(300)
    shapes = spark.createDataFrame([(k, r) for k, *_, r in rows], "key string, rings array<array<struct<x: double, y: double>>>")
    points = [(i, (i * 29 % 240) / 10 - 11.97, (i * 31 % 230) / 10 - 11.47) for i in range(400)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    for count in (1, 3):
        hits = point_in_polygon(df, shapes, id_col="id", least=F.col("key"), least_count=count)
        got = {}
        for r in hits.collect():
            got.setdefault(r.id, set()).add(r.key)
        want = {i: sorted(k for k, x, y, r, _ in rows if abs(px - x) < r and abs(py - y) < r)[:count] for i, px, py in points}
        assert {i: sorted(k)[:count] for i, k in got.items()} == {i: k for i, k in want.items() if k}
    index = grid.cell_index(shapes, splits=8)
    assert grid.smallest_kept(index, F.col("key")).count() < index.count() / 2


def test_nearest_among_many_around_a_point(spark):
    rows = _stacked(60)
    shapes = spark.createDataFrame([(k, r) for k, *_, r in rows], "key string, rings array<array<struct<x: double, y: double>>>")
    points = [(i, (i * 29 % 400) / 10 - 19.97, (i * 31 % 400) / 10 - 19.47) for i in range(150)] + [(None, 0.01, 0.01), (7, 30.0, 30.0), (900, -200.0, 0.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    got = sorted(((r.id, r.key, round(r.distance_m, 6), r["rank"]) for r in nearest(df, shapes, id_col="id", key="key", max_distance=8.0, limit=3).collect()), key=str)
    best = {}
    for i, px, py in points:
        for k, x, y, r, _ in rows:
            d = (max(abs(px - x) - r, 0) ** 2 + max(abs(py - y) - r, 0) ** 2) ** 0.5
            if d <= 8:
                best.setdefault(i, {})[k] = min(d, best.get(i, {}).get(k, d))
    want = [(i, k, round(d, 6), n + 1) for i, ds in best.items() for n, (d, k) in enumerate(sorted((d, k) for k, d in ds.items())[:3])]
    assert got == sorted(want, key=str)


def test_k_nearest_meets_few_of_many_boundaries(spark, monkeypatch):
    """However dense the boundaries are, a point is measured against few of them; results equal all pairs."""
    rows = [(f"k{i * 7919 % 3000:04d}", (i * 37 % 500) / 10, (i * 53 % 301) / 10, 0.3 + i % 4 * 0.4, i) for i in range(3000)]
    box = lambda x, y, r: [[(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r), (x - r, y - r)]]
    shapes = spark.createDataFrame([(k, box(x, y, r)) for k, x, y, r, _ in rows], "key string, rings array<array<struct<x: double, y: double>>>")
    points = [(i, (i * 29 % 800) / 10 - 14.97, (i * 31 % 600) / 10 - 14.53) for i in range(120)] + [(None, 25.01, 15.01), (7, -80.0, 3.0), (900, 51.3, 15.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    counts, measured = [], proximity._measured

    def counted(reach, some, need):
        out = measured(reach, some, need)
        counts.append((reach.count(), out.count()))
        return out

    monkeypatch.setattr(proximity, "_measured", counted)
    got = sorted(((r.id, r.key, round(r.distance_m, 6), r["rank"]) for r in k_nearest(df, shapes, id_col="id", key="key", limit=3).collect()), key=str)
    assert len(counts) > 1 and all(points < len(df.collect()) and met < 60 * points for points, met in counts)
    want = []
    for i, px, py in points:
        near = sorted((((max(abs(px - x) - r, 0) ** 2 + max(abs(py - y) - r, 0) ** 2) ** 0.5), k) for k, x, y, r, _ in rows)
        want += [(i, k, round(d, 6), n + 1) for n, (d, k) in enumerate(near[:3])]
    assert got == sorted(want, key=str)


def _joins(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.splitlines() if "Join " in line]


def test_pairs_are_compared_by_columns(spark):
    """The join looks at numbers for each pair, whatever the number of shapes around a point."""
    rows = _stacked(200)
    shapes = spark.createDataFrame([(k, r) for k, *_, r in rows], "key string, rings array<array<struct<x: double, y: double>>>")
    points = [(i, (i * 29 % 240) / 10 - 11.97, (i * 31 % 230) / 10 - 11.47) for i in range(300)] + [(7, 0.01, 0.01), (None, 0.01, 0.01), (8, None, 0.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    out = point_in_polygon(df, shapes)
    joins = [line for line in _joins(out) if "_flip" in line]
    assert len(joins) == 1 and "lambda" not in joins[0]
    want = sorted(((i, k) for i, px, py in points if px is not None for k, x, y, r, _ in rows if abs(px - x) < r and abs(py - y) < r), key=str)
    assert sorted(((r.id, r.key) for r in out.collect()), key=str) == want


def comb(teeth, width=0.05):
    """Thin teeth side by side, so that one height meets two edges a tooth."""
    ring = [(0.0, 0.0)]
    for i in range(teeth):
        ring += [(i * width, 1.0), ((i + 0.5) * width, 0.1), ((i + 0.6) * width, 0.1)]
    return [*ring, (teeth * width, 0.0), (0.0, 0.0)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_cells_with_many_edges_at_one_height(spark, how):
    """They do not fit the columns of a slab and are joined by themselves, once."""
    shapes = {"comb": comb(20), "big": comb(90, 0.02), "box": box(0.1, 0.1, 2.1, 2.1), "bow": [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]}
    polys = spark.createDataFrame([(k, k, as_rings(v)) for k, v in shapes.items()], SCHEMA)
    rng = np.random.default_rng(3)
    places = [(float(x), float(y)) for x, y in rng.uniform(-0.2, 2.3, (1500, 2))] + [c for ring in shapes.values() for c in ring]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places)], "id long, x double, y double")
    for few in (polys.filter("geoid = 'comb'"), polys):
        want = points.join(few, F.expr(g.contains("rings", "x", "y")), how).select("id", "geoid").collect()
        for splits in (None, 2):
            index = grid.cell_index(few, splits=splits)
            assert grid.tangled(index).count() > 0
            for given in (few, index):
                got = point_in_polygon(points, given, splits=splits, how=how, id_col="id").select("id", "geoid").collect()
                assert sorted(got, key=str) == sorted(want, key=str)


def test_many_points_do_not_travel_to_every_task(spark, world, monkeypatch):
    """A large index is joined by sorting, however small the points look by their bytes."""
    polys, points, shapes, pts = world
    monkeypatch.setattr(grid, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(grid, "MANY_PROBES", 500)
    out = point_in_polygon(points, polys).select("id", "geoid")
    assert "SortMergeJoin" in out._jdf.queryExecution().sparkPlan().toString()
    assert {(r.id, r.geoid) for r in out.collect()} == want(shapes, pts)


def test_boundaries_over_each_other_come_in_rounds(spark, monkeypatch):
    """The smallest of many boundaries that cover no cell wholly: later ones are cut only where points are left."""
    monkeypatch.setattr(grid, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(pip, "BROADCAST_BYTES", 1 << 20)
    monkeypatch.setattr(pip, "FIRST_ROUND", 8)
    met, within = [], pip.index_within

    def counted(shapes, keep, cells, on):
        out = within(shapes, keep, cells, on)
        met.append((shapes.count(), out.select("no").distinct().count()))
        return out

    monkeypatch.setattr(pip, "index_within", counted)
    rows = []
    for i in range(600):
        # Triangles of three kinds, one without a name; some lie far off, keys come twice or are missing.
        x, y, r, kind = (i * 37 % 23) / 10 + (40.0 if i % 50 == 49 else 0.0), (i * 53 % 19) / 10, 3 + i % 3, ["a", "b", None][i % 3]
        key = f"k{i * 7919 % 600 // 2:04d}" if i % 97 else None
        rows.append((i, key, kind, [(x - r, y - r), (x + r, y - r - 1), (x, y + r), (x - r, y - r)]))
    shapes = spark.createDataFrame([(*row, as_rings(ring)) for *row, ring in rows], f"no int, key string, kind string, rings {g.RINGS}")
    places = [((i * 29 % 30) / 10 - 0.47, (i * 31 % 25) / 10 - 0.47) for i in range(200)] + [(41.03, 1.02), (44.2, 0.3), (500.0, 1.0), (float("nan"), 0.0)]
    # Ids come twice, for different places, and the last places have none, or no place.
    points = [(i // 2, x, y) for i, (x, y) in enumerate(places)] + [(None, 0.51, 0.52), (9, None, 0.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    known = lambda key: (key is None, key or "")
    for by in ((), ("kind",)):
        met.clear()
        out = point_in_polygon(df, shapes, least=F.struct(F.col("key").isNull(), F.col("key")), least_by=by)
        assert out.columns == ["id", "x", "y", "no", "key", "kind"]
        got = [(str(r.id), r.x, r.y, str(r.kind) if by else "", known(r.key)) for r in out.collect()]
        best = {}
        for n, (i, px, py) in enumerate(points):
            for _, key, kind, ring in rows:
                if px is not None and inside(ring, px, py):
                    at = (n, str(i), px, py, str(kind) if by else "")
                    best[at] = min(known(key), best.get(at, known(key)))
        assert sorted(got) == sorted((*at[1:], key) for at, key in best.items())
        assert len(met) == 3 and sum(n for n, _ in met) == 600 and sum(cut for _, cut in met) < 300


def test_shapes_are_read_once_and_where_their_rows_are(spark):
    """Conditions on rings do not go below the exchange that spreads few large files, nor repeat the reading."""
    texts = spark.range(9).selectExpr("id", "concat('POLYGON ((0 0, ', id, ' 0, ', id, ' 1, 0 0))') AS wkt").repartition(3)
    shapes = grid._zoomed(with_rings(texts), "rings", None, ["id"])
    plan = shapes._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("RLIKE") == 1 and plan.index("RLIKE") < plan.index("REPARTITION")
    assert sorted(r.id for r in shapes.collect()) == list(range(1, 9))

"""Spatial queries over the derived civic tables, with their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions import projection as p
from plumbline.functions.registry import register_functions
from plumbline.operators.hull import convex_hulls, reock_scores
from plumbline.operators.overlay import intersecting_pairs, intersection_table, overlap_geometry
from plumbline.operators.pip import label_matches_space, point_in_polygon
from plumbline.operators.proximity import nearest
from plumbline.plans import assignment, clustering, enrichment, serving, warehouse
from plumbline.queries import bindings as b
from plumbline.queries.registration import Registry
from plumbline.session import new_path, spool
from plumbline.sources import geojson
from plumbline.streaming.placement import place_stream, write_stream

query = Registry()


# --- Points in boundaries ---


@query(b.with_hits("state") + " SELECT addr.id, hits.geoid, hits.name FROM addr LEFT JOIN hits ON addr.id = hits.id")
def state_of_address(spark, sf):
    return point_in_polygon(
        b.addresses(spark, sf).select("id", "x", "y"), b.boundaries(spark, sf, "state"), how="left", id_col="id"
    ).select("id", "geoid", "name")


@query(b.with_hits("state") + " SELECT name AS state_name, count(*) AS addresses FROM hits GROUP BY name")
def addresses_per_state(spark, sf):
    hits = point_in_polygon(b.addresses(spark, sf).select("id", "x", "y"), b.boundaries(spark, sf, "state"))
    return hits.groupBy(F.col("name").alias("state_name")).agg(F.count("*").alias("addresses"))


@query(b.with_hits("county") + " SELECT id, geoid FROM hits")
def counties_of_address(spark, sf):
    return point_in_polygon(b.addresses(spark, sf).select("id", "x", "y"), b.boundaries(spark, sf, "county")).select("id", "geoid")


@query(b.with_hits("cd") + " SELECT id, geoid FROM hits")
def districts_of_address(spark, sf):
    return point_in_polygon(b.addresses(spark, sf).select("id", "x", "y"), b.boundaries(spark, sf, "cd")).select("id", "geoid")


@query(
    b.with_hits("state")
    + " SELECT a.id, count(h.id) > 0 AS matches FROM (SELECT addr.id, coalesce(n.n_name, '') AS label FROM addr "
    "LEFT JOIN nation n ON n.n_nationkey = addr.c_nationkey) a LEFT JOIN hits h ON h.id = a.id AND h.name = a.label GROUP BY a.id"
)
def label_matches_state(spark, sf):
    labelled = b.sql(
        spark, sf, f"SELECT a.*, concat(' ', n_name, ' ') AS label FROM ({b.ADDRESSES}) a JOIN {{nation}} ON n_nationkey = c_nationkey",
        "customer", "nation",
    )
    return label_matches_space(
        labelled, b.boundaries(spark, sf, "state"), label="label", name="name", id_col="id", flag="matches"
    ).select("id", "matches")


_LABEL_POINTS = """, ys AS (SELECT DISTINCT geoid, y1 AS y FROM edges WHERE summary_level = 'county'),
mids AS (SELECT geoid, (min(y) + max(y)) / 2 AS m FROM ys GROUP BY geoid),
line AS (SELECT ys.geoid, (min(y) FILTER (WHERE y > m) + max(y) FILTER (WHERE y <= m)) / 2 AS l
         FROM ys JOIN mids USING (geoid) GROUP BY ys.geoid),
cuts AS (SELECT e.geoid, l, (x2 - x1) * (l - y1) / (y2 - y1) + x1 AS x,
                row_number() OVER (PARTITION BY e.geoid ORDER BY (x2 - x1) * (l - y1) / (y2 - y1) + x1) AS k
         FROM edges e JOIN line USING (geoid) WHERE summary_level = 'county' AND (y1 > l) <> (y2 > l)),
spans AS (SELECT c.geoid, c.l, d.x - c.x AS w, (c.x + d.x) / 2 AS m FROM cuts c JOIN cuts d ON c.geoid = d.geoid AND d.k = c.k + 1 AND c.k % 2 = 1),
labels_at AS (SELECT geoid, arg_max(m, w) AS px, any_value(l) AS py FROM spans GROUP BY geoid)
SELECT q.geoid, round(q.px, 6) AS px, round(q.py, 6) AS py, 'ST_Polygon' AS geometry_type, e.geoid AS state_geoid
FROM labels_at q JOIN edges e ON e.summary_level = 'state' AND (e.y1 > q.py) <> (e.y2 > q.py)
  AND q.px < (e.x2 - e.x1) * (q.py - e.y1) / (e.y2 - e.y1) + e.x1
GROUP BY ALL HAVING count(*) % 2 = 1"""


@query(b.with_edges("county", "state") + _LABEL_POINTS)
def label_points_in_states(spark, sf):
    """Interior label points of the counties, placed in states."""
    points = b.boundary_texts(spark, sf, "county").selectExpr(
        "geoid", f"{g.geometry_type('wkt')} AS geometry_type", f"{g.rings_from_wkt('wkt')} AS rings"
    ).selectExpr("geoid", "geometry_type", f"{g.point_on_surface('rings')} AS pt")
    points = points.select("geoid", "geometry_type", F.col("pt.x").alias("px"), F.col("pt.y").alias("py"))
    states = b.boundaries(spark, sf, "state").select(F.col("geoid").alias("state_geoid"), "rings")
    return point_in_polygon(points, states, x="px", y="py").select(
        "geoid", F.round("px", 6).alias("px"), F.round("py", 6).alias("py"), "geometry_type", "state_geoid"
    )


@query(
    b.with_hits("state", "county", "tract", "vtd", "cd")
    + """, lv AS (SELECT id, min(geoid) FILTER (WHERE summary_level = 'state') AS s, min(geoid) FILTER (WHERE summary_level = 'county') AS c,
    min(geoid) FILTER (WHERE summary_level = 'tract') AS t, min(geoid) FILTER (WHERE summary_level = 'vtd') AS v,
    min(geoid) FILTER (WHERE summary_level = 'cd') AS d FROM hits GROUP BY id)
    SELECT a.id, s AS state_geoid, CASE WHEN s IS NOT NULL THEN c END AS county_geoid,
    CASE WHEN s IS NOT NULL AND c IS NOT NULL THEN t END AS tract_geoid, CASE WHEN s IS NOT NULL AND c IS NOT NULL THEN v END AS vtd_geoid,
    CASE WHEN s IS NOT NULL THEN d END AS cd_geoid, s IS NOT NULL AS assigned, CASE WHEN s IS NOT NULL THEN 'SPATIAL_JOIN' END AS assignment_method
    FROM addr a LEFT JOIN lv ON lv.id = a.id"""
)
def boundary_assignment(spark, sf):
    out = assignment.assign_boundaries(b.addresses(spark, sf), b.boundaries(spark, sf), vintage_year=2020)
    return out.select("id", "state_geoid", "county_geoid", "tract_geoid", "vtd_geoid", "cd_geoid", "assigned", "assignment_method")


@query(
    b.with_hits("state")
    + " SELECT count(*) AS processed, count(DISTINCT hits.id) AS assigned, count(*) - count(DISTINCT hits.id) AS failed "
    "FROM addr LEFT JOIN hits ON hits.id = addr.id"
)
def assignment_summary(spark, sf):
    out = assignment.assign_boundaries(b.addresses(spark, sf), b.boundaries(spark, sf, "state"), vintage_year=2020)
    return assignment.run_summary(out)


_PLAN_ROWS = (
    "SELECT concat('A', {pad}) AS plan_id, {pad} AS state_fips, 'congress' AS chamber, CAST('2022-01-01' AS DATE) AS effective_from, "
    "CAST('2023-06-08' AS DATE) AS effective_to FROM {nation} WHERE n_nationkey % 4 <> 3 UNION ALL "
    "SELECT concat('B', {pad}), {pad}, 'congress', CAST('2023-06-08' AS DATE), CAST(NULL AS DATE) FROM {nation} WHERE n_nationkey % 4 < 2"
).replace("{pad}", b.pad("n_nationkey", 2))


@query(
    b.with_hits("state", "county", "cd")
    + ", plans AS ("
    + _PLAN_ROWS.format(nation="nation")
    + """), lv AS (SELECT id, min(geoid) FILTER (WHERE summary_level = 'state') AS s, min(geoid) FILTER (WHERE summary_level = 'cd') AS d FROM hits GROUP BY id),
    dated AS (SELECT addr.id, s, d, CAST('2023-05-01' AS DATE) + CAST(addr.id % 60 AS INT) AS dt FROM addr JOIN lv ON lv.id = addr.id WHERE s IS NOT NULL),
    act AS (SELECT dated.*, p.plan_id FROM dated LEFT JOIN plans p ON p.state_fips = s AND dt >= effective_from AND (effective_to IS NULL OR dt <= effective_to)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY effective_from DESC) = 1),
    pd AS (SELECT act.id, min(h.geoid) AS g FROM act JOIN hits h ON h.id = act.id AND h.summary_level = 'county'
        AND substr(h.geoid, 1, 2) = substr(plan_id, 2, 2) AND (CAST(substr(h.geoid, 3) AS INT) % 2 = 1) = (plan_id LIKE 'A%') GROUP BY act.id)
    SELECT act.id, coalesce(pd.g, act.d) AS cd_geoid, plan_id, CASE WHEN pd.g IS NULL THEN 'SPATIAL_JOIN' ELSE 'PLAN_SPATIAL_JOIN' END AS assignment_method
    FROM act LEFT JOIN pd ON pd.id = act.id"""
)
def plan_aware_assignment(spark, sf):
    """Districts of the plan active on each address's date; hand-over days go to the later plan."""
    plans = b.sql(spark, sf, _PLAN_ROWS, "nation")
    districts = b.boundaries(spark, sf, "county").select(
        F.expr("concat(CASE WHEN CAST(substr(geoid, 3) AS INT) % 2 = 1 THEN 'A' ELSE 'B' END, substr(geoid, 1, 2))").alias("plan_id"),
        F.lit("").alias("geoid"), F.col("geoid").alias("district_number"), "rings",
    )
    out = assignment.assign_boundaries(
        b.addresses(spark, sf), b.boundaries(spark, sf, "state", "cd"), vintage_year=2020, plans=plans, plan_districts=districts,
        context_date=F.expr("date_add(DATE'2023-05-01', CAST(id % 60 AS INT))"),
    )
    return out.filter("assigned").select("id", "cd_geoid", "plan_id", "assignment_method")


@query(
    b.with_hits("state", "county", "tract")
    + " SELECT id, summary_level AS boundary_type, min(geoid) AS geoid FROM hits GROUP BY ALL"
)
def boundaries_around_points(spark, sf):
    shapes = b.boundaries(spark, sf, "state", "county", "tract").withColumnRenamed("summary_level", "boundary_type")
    out = serving.boundaries_of_points(b.addresses(spark, sf), shapes, types=["state", "county", "tract", "river"], year=2020)
    return out.select("id", "boundary_type", "geoid")


@query(
    b.with_hits("state", "county", "cd")
    + """, lv AS (SELECT id, min({'g': geoid, 'n': name}) FILTER (WHERE summary_level = 'state') AS s,
    min({'g': geoid, 'n': name}) FILTER (WHERE summary_level = 'county') AS c, min({'g': geoid, 'n': name}) FILTER (WHERE summary_level = 'cd') AS d FROM hits GROUP BY id)
    SELECT a.id, s.g AS state_geoid, s.n AS state_name, c.g AS county_geoid, c.n AS county_name, d.g AS cd_geoid, d.n AS cd_name FROM addr a LEFT JOIN lv ON lv.id = a.id"""
)
def address_boundary_names(spark, sf):
    return enrichment.add_boundary_names(
        b.addresses(spark, sf).select("id", "x", "y"), b.boundaries(spark, sf, "state", "county", "cd"), 2020, x="x", y="y", first_only=True
    ).drop("x", "y")


@query(b.with_hits("county") + " SELECT id, geoid FROM hits")
def stream_point_placement(spark, sf):
    """The county join on a file stream, drained once; each input row arrives exactly once."""
    customers = b.read(spark, sf, "customer")
    source, out, marks = (new_path(spark, n) for n in ("source", "placed", "marks"))
    b.spread(customers).write.parquet(source)
    stream = spark.readStream.schema(customers.schema).parquet(source).selectExpr(
        "c_custkey AS id", f"{b.ADDRESS_X} AS x", f"{b.ADDRESS_Y} AS y"
    )
    run = write_stream(place_stream(stream, b.boundaries(spark, sf, "county")).select("id", "geoid"), out, marks)
    run.awaitTermination()
    return spark.read.schema("id BIGINT, geoid STRING").parquet(out)


# --- Overlay ---

# Boxes with whole-number corners: counties from suppliers, VTDs from parts, districts as shifted tiles.
_BOXES = {
    "county": ("supplier", b.SHAPES["county"][1], f"{b._SX} - {b._SR}", f"{b._SY} - {b._SR}", f"{b._SX} + {b._SR}", f"{b._SY} + {b._SR} + 1"),
    "vtd": ("part", b.SHAPES["vtd"][1], f"{b._PX} - {b._PR}", f"{b._PY} - {b._PR}", f"{b._PX} + {b._PR}", f"{b._PY} + {b._PR} + 1"),
    "cd": ("nation", b.SHAPES["state"][1], f"{b._X0} + 3", f"{b._Y0} + 2", f"{b._X0} + 75", f"{b._Y0} + 38"),
}


def _boxes(spark, sf, kind):
    table, geoid, *corners = _BOXES[kind]
    x0, y0, x1, y1 = (b._d(c) for c in corners)
    ring = ", ".join(g.point(x, y) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)))
    return b.spread(b.read(spark, sf, table)).selectExpr(f"{geoid} AS geoid", "2020 AS vintage_year", f"array(array({ring})) AS rings")


def _box_rows(kind):
    table, geoid, *corners = _BOXES[kind]
    x0, y0, x1, y1 = (b._d(c) for c in corners)
    return f"SELECT {geoid} AS geoid, {x0} AS x0, {y0} AS y0, {x1} AS x1, {y1} AS y1 FROM {table}"


def _overlap_check(kind, body):
    return f"""WITH a AS ({_box_rows(kind)}), d AS ({_box_rows('cd')}),
    pairs AS (SELECT a.geoid AS src, d.geoid AS cd, (least(a.x1, d.x1) - greatest(a.x0, d.x0)) * (least(a.y1, d.y1) - greatest(a.y0, d.y0)) AS area,
        (a.x1 - a.x0) * (a.y1 - a.y0) AS area_a, (d.x1 - d.x0) * (d.y1 - d.y0) AS area_d FROM a JOIN d
        ON least(a.x1, d.x1) > greatest(a.x0, d.x0) AND least(a.y1, d.y1) > greatest(a.y0, d.y0)),
    pct AS (SELECT *, area / area_a * 100 AS p, area / area_d * 100 AS q FROM pairs) {body}"""


@query(_overlap_check("county", """SELECT src AS county_geoid, cd AS cd_geoid, 2020 AS year, CAST(floor(area + 1e-6) AS BIGINT) AS intersection_area_sqm,
    round(p, 2) AS pct_of_county, round(q, 2) AS pct_of_cd, CASE WHEN p >= 99.9 THEN 'COUNTY_IN_CD' WHEN q >= 99.9 THEN 'CD_IN_COUNTY' ELSE 'SPLIT' END AS relationship,
    round(p, 9) > 50 AS is_dominant FROM pct WHERE greatest(p, q) >= 1"""))
def county_district_overlap(spark, sf):
    out = intersection_table(_boxes(spark, sf, "county"), _boxes(spark, sf, "cd"), source_type="county")
    return out.select(
        "county_geoid", "cd_geoid", "year", "intersection_area_sqm", F.col("pct_of_county").cast("double"), F.col("pct_of_cd").cast("double"),
        "relationship", "is_dominant",
    )


# Longitude and latitude boxes within the conterminous states; districts overlap their neighbours.
_LONLAT = {
    "county": ("supplier", b.SHAPES["county"][1], "-120 + s_suppkey * 37 % 460 / 10e0", "26 + s_suppkey * 53 % 200 / 10e0", "0.5e0 + s_suppkey % 5 * 0.3e0", "0.4e0 + s_suppkey % 4 * 0.3e0"),
    "cd": ("nation", b.SHAPES["state"][1], "-122e0 + 10 * (n_nationkey % 5)", "25e0 + 5 * floor(n_nationkey / 5)", "10.25e0", "5.25e0"),
}


def _lonlat(spark, sf, kind):
    table, geoid, x, y, w, h = _LONLAT[kind]
    ring = ", ".join(g.point(px, py) for px, py in (("x", "y"), ("x + w", "y"), ("x + w", "y + h"), ("x", "y + h"), ("x", "y")))
    return b.spread(b.read(spark, sf, table)).selectExpr(f"{geoid} AS geoid", f"{x} AS x", f"{y} AS y", f"{w} AS w", f"{h} AS h").selectExpr(
        "geoid", "2020 AS vintage_year", f"array(array({ring})) AS rings"
    )


# Snyder's formulas with the constants worked out by the checking engine itself.
_PROJECTIONS = """WITH k AS (SELECT 1 / 298.257222101e0 AS f), e AS (SELECT f * (2 - f) AS e2, sqrt(f * (2 - f)) AS e FROM k),
    c AS (SELECT e2, e, radians(29.5) AS a1, radians(45.5) AS a2, radians(23) AS a0, radians(37) AS l1, radians(39.5) AS l2, radians(36) AS l0 FROM e),
    q AS (SELECT *, cos(a1) / sqrt(1 - e2 * sin(a1) * sin(a1)) AS m1, cos(a2) / sqrt(1 - e2 * sin(a2) * sin(a2)) AS m2,
        (1 - e2) * (sin(a1) / (1 - e2 * sin(a1) * sin(a1)) - ln((1 - e * sin(a1)) / (1 + e * sin(a1))) / (2 * e)) AS q1,
        (1 - e2) * (sin(a2) / (1 - e2 * sin(a2) * sin(a2)) - ln((1 - e * sin(a2)) / (1 + e * sin(a2))) / (2 * e)) AS q2,
        (1 - e2) * (sin(a0) / (1 - e2 * sin(a0) * sin(a0)) - ln((1 - e * sin(a0)) / (1 + e * sin(a0))) / (2 * e)) AS q0,
        cos(l1) / sqrt(1 - e2 * sin(l1) * sin(l1)) AS k1, cos(l2) / sqrt(1 - e2 * sin(l2) * sin(l2)) AS k2,
        tan(pi() / 4 - l1 / 2) / pow((1 - e * sin(l1)) / (1 + e * sin(l1)), e / 2) AS t1,
        tan(pi() / 4 - l2 / 2) / pow((1 - e * sin(l2)) / (1 + e * sin(l2)), e / 2) AS t2,
        tan(pi() / 4 - l0 / 2) / pow((1 - e * sin(l0)) / (1 + e * sin(l0)), e / 2) AS t0 FROM c),
    n AS (SELECT *, (m1 * m1 - m2 * m2) / (q2 - q1) AS n, (ln(k1) - ln(k2)) / (ln(t1) - ln(t2)) AS ln_ FROM q),
    r AS (SELECT *, m1 * m1 + n * q1 AS cc, k1 / (ln_ * pow(t1, ln_)) AS ff FROM n)"""
_Q = "(1 - e2) * (sin(lat) / (1 - e2 * sin(lat) * sin(lat)) - ln((1 - e * sin(lat)) / (1 + e * sin(lat))) / (2 * e))"



def _projected_corners(kind):
    """Corners of the boxes in EPSG:5070, counter-clockwise, with the next one."""
    table, geoid, x, y, w, h = _LONLAT[kind]
    return f"""SELECT geoid, i, px AS x1, py AS y1, coalesce(lead(px) OVER ring, first(px) OVER ring) AS x2, coalesce(lead(py) OVER ring, first(py) OVER ring) AS y2
    FROM (SELECT geoid, i, 6378137 * sqrt(cc - n * qq) / n * sin(n * (lon - radians(-96))) AS px,
        6378137 * sqrt(cc - n * q0) / n - 6378137 * sqrt(cc - n * qq) / n * cos(n * (lon - radians(-96))) AS py
      FROM (SELECT geoid, i, lon, {_Q} AS qq, cc, n, q0 FROM r, (SELECT geoid, c.i, radians(c.lon) AS lon, radians(c.lat) AS lat
        FROM (SELECT geoid, unnest([{{'i': 1, 'lon': x, 'lat': y}}, {{'i': 2, 'lon': x + w, 'lat': y}}, {{'i': 3, 'lon': x + w, 'lat': y + h}}, {{'i': 4, 'lon': x, 'lat': y + h}}]) AS c
          FROM (SELECT {geoid} AS geoid, {x} AS x, {y} AS y, {w} AS w, {h} AS h FROM {table})))))
    WINDOW ring AS (PARTITION BY geoid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


# The common part of two convex shapes: corners of one within the other and crossings of their sides, in order around their middle.
_LONLAT_CHECK = f"""{_PROJECTIONS}, a AS ({_projected_corners('county')}), d AS ({_projected_corners('cd')}),
    ba AS (SELECT geoid, min(x1) AS x0, max(x1) AS x9, min(y1) AS y0, max(y1) AS y9, sum(x1 * y2 - x2 * y1) / 2 AS area FROM a GROUP BY geoid),
    bd AS (SELECT geoid, min(x1) AS x0, max(x1) AS x9, min(y1) AS y0, max(y1) AS y9, sum(x1 * y2 - x2 * y1) / 2 AS area FROM d GROUP BY geoid),
    near AS (SELECT ba.geoid AS src, bd.geoid AS cd, ba.area AS area_a, bd.area AS area_d FROM ba JOIN bd ON ba.x0 < bd.x9 AND bd.x0 < ba.x9 AND ba.y0 < bd.y9 AND bd.y0 < ba.y9),
    sides AS (SELECT src, cd, a.i, a.x1 AS ax, a.y1 AS ay, a.x2 - a.x1 AS au, a.y2 - a.y1 AS av, d.i AS j, d.x1 AS dx, d.y1 AS dy, d.x2 - d.x1 AS du, d.y2 - d.y1 AS dv
        FROM near JOIN a ON a.geoid = src JOIN d ON d.geoid = cd),
    pts AS (
      SELECT src, cd, ax AS x, ay AS y FROM sides GROUP BY src, cd, i, ax, ay HAVING min(du * (ay - dy) - dv * (ax - dx)) >= 0
      UNION ALL SELECT src, cd, dx, dy FROM sides GROUP BY src, cd, j, dx, dy HAVING min(au * (dy - ay) - av * (dx - ax)) >= 0
      UNION ALL SELECT src, cd, ax + t * au, ay + t * av FROM (
        SELECT *, ((dx - ax) * dv - (dy - ay) * du) / (au * dv - av * du) AS t, ((dx - ax) * av - (dy - ay) * au) / (au * dv - av * du) AS u FROM sides WHERE au * dv <> av * du)
      WHERE t BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1),
    mid AS (SELECT src, cd, avg(x) AS mx, avg(y) AS my FROM pts GROUP BY ALL HAVING count(*) > 2),
    turn AS (SELECT src, cd, mx, my, x - mx AS x, y - my AS y, atan2(y - my, x - mx) AS w FROM pts JOIN mid USING (src, cd)),
    legs AS (SELECT src, cd, mx, my, x, y, coalesce(lead(x) OVER o, first(x) OVER o) AS nx, coalesce(lead(y) OVER o, first(y) OVER o) AS ny FROM turn
      WINDOW o AS (PARTITION BY src, cd ORDER BY w, x ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    sums AS (SELECT src, cd, sum(x * ny - nx * y) / 2 AS area, any_value(mx) + sum((x + nx) * (x * ny - nx * y)) / nullif(3 * sum(x * ny - nx * y), 0) AS cx,
      any_value(my) + sum((y + ny) * (x * ny - nx * y)) / nullif(3 * sum(x * ny - nx * y), 0) AS cy FROM legs GROUP BY src, cd),
    pct AS (SELECT *, area / area_a * 100 AS p, area / area_d * 100 AS q FROM sums JOIN near USING (src, cd))
    SELECT src AS county_geoid, cd AS cd_geoid, 2020 AS year, round(area / 1e6, 1) AS intersection_sqkm, round(p, 2) AS pct_of_county, round(q, 2) AS pct_of_cd,
      CASE WHEN p >= 99.9 THEN 'COUNTY_IN_CD' WHEN q >= 99.9 THEN 'CD_IN_COUNTY' ELSE 'SPLIT' END AS relationship, p > 50 AS is_dominant,
      round(area / 1e6, 1) AS shape_sqkm, round(cx / 1000, 1) AS centre_x_km, round(cy / 1000, 1) AS centre_y_km FROM pct WHERE greatest(p, q) >= 1"""


@query(_LONLAT_CHECK)
def projected_district_overlap(spark, sf):
    """Overlaps of boundaries in longitude and latitude, measured in EPSG:5070, with the area and the centre of the stored shape."""
    out = intersection_table(_lonlat(spark, sf, "county"), _lonlat(spark, sf, "cd"), source_type="county", projection="albers", shape=True)
    cross = "(ce.x1 * ce.y2 - ce.x2 * ce.y1)"
    total = lambda term: f"aggregate(edges, 0D, (ce_s, ce) -> ce_s + {term})"
    centre = {v: f"round({total(f'(ce.{v}1 + ce.{v}2) * {cross}')} / (3 * {total(cross)}) / 1000, 1) AS centre_{v}_km" for v in "xy"}
    out = out.withColumn("edges", F.expr(g.edges("intersection_rings")))
    return out.selectExpr(
        "county_geoid", "cd_geoid", "year", "round(intersection_area_sqm / 1e6, 1) AS intersection_sqkm", "CAST(pct_of_county AS DOUBLE) AS pct_of_county",
        "CAST(pct_of_cd AS DOUBLE) AS pct_of_cd", "relationship", "is_dominant", f"round({g.area('intersection_rings')} / 1e6, 1) AS shape_sqkm", *centre.values(),
    )


@query(_overlap_check("vtd", """SELECT src AS vtd_geoid, cd AS cd_geoid, round(p, 2) AS pct_of_vtd, round(p, 9) > 50 AS is_dominant FROM pct WHERE p >= 10"""))
def vtd_district_overlap(spark, sf):
    out = intersection_table(_boxes(spark, sf, "vtd"), _boxes(spark, sf, "cd"), source_type="vtd", min_overlap=10.0)
    return out.select("vtd_geoid", "cd_geoid", F.col("pct_of_vtd").cast("double"), "is_dominant")


@query(_overlap_check("county", "SELECT src AS source_id, cd AS target_id, round(p, 2) AS pct_of_source FROM pct WHERE greatest(p, q) >= 1"))
def stored_overlap_lookup(spark, sf):
    """The overlap table written once and read back by the lookup."""
    table = spool(intersection_table(_boxes(spark, sf, "county"), _boxes(spark, sf, "cd"), source_type="county"), "overlaps")
    return serving.overlaps_of(table, "county", year=2020).select("source_id", "target_id", "pct_of_source")


@query(_overlap_check("county", "SELECT src AS county_geoid, cd AS cd_geoid, round(area, 3) AS overlap_area FROM pairs"))
def overlap_shapes(spark, sf):
    """Areas of the stitched common shapes."""
    a = _boxes(spark, sf, "county").withColumnRenamed("geoid", "county_geoid")
    d = _boxes(spark, sf, "cd").withColumnRenamed("geoid", "cd_geoid")
    shapes = overlap_geometry(a, d, a_key="county_geoid", b_key="cd_geoid")
    return shapes.select("county_geoid", "cd_geoid", F.expr(f"round({g.area('rings')}, 3)").alias("overlap_area"))


@query(f"""WITH a AS ({_box_rows('county')}), d AS ({_box_rows('cd')}) SELECT a.geoid AS county_geoid, d.geoid AS cd_geoid FROM a JOIN d
    ON least(a.x1, d.x1) >= greatest(a.x0, d.x0) AND least(a.y1, d.y1) >= greatest(a.y0, d.y0)""")
def touching_pairs(spark, sf):
    a = _boxes(spark, sf, "county").withColumnRenamed("geoid", "county_geoid")
    d = _boxes(spark, sf, "cd").withColumnRenamed("geoid", "cd_geoid")
    return intersecting_pairs(a, d, a_key="county_geoid", b_key="cd_geoid")


# --- Distance and measures ---


@query(
    b.with_hits("county")
    + """, cand AS (SELECT p.id, p.x, p.y, e.geoid, e.x1, e.y1, e.x2, e.y2,
    least(1.0, greatest(0.0, ((p.x - e.x1) * (e.x2 - e.x1) + (p.y - e.y1) * (e.y2 - e.y1)) / (pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2)))) AS t
    FROM addr p JOIN edges e ON p.x BETWEEN least(e.x1, e.x2) - 6 AND greatest(e.x1, e.x2) + 6 AND p.y BETWEEN least(e.y1, e.y2) - 6 AND greatest(e.y1, e.y2) + 6),
    dist AS (SELECT id, geoid, sqrt(pow(x - x1 - t * (x2 - x1), 2) + pow(y - y1 - t * (y2 - y1), 2)) AS d FROM cand
        UNION ALL SELECT id, geoid, 0.0 FROM hits),
    best AS (SELECT id, geoid, min(d) AS d FROM dist GROUP BY ALL HAVING min(d) <= 6)
    SELECT id, geoid, round(d, 6) AS distance_m, CAST(row_number() OVER (PARTITION BY id ORDER BY d, geoid) AS INT) AS rank FROM best
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, geoid) <= 3"""
)
def nearest_counties(spark, sf):
    out = nearest(b.addresses(spark, sf), b.boundaries(spark, sf, "county"), id_col="id", key="geoid", max_distance=6.0, limit=3)
    return out.select("id", "geoid", F.round("distance_m", 6).alias("distance_m"), "rank")


# Every point against every county's sides, both projected by the checking engine.
@query(f"""{_PROJECTIONS}, corners AS ({_projected_corners('county')}),
    pts AS (SELECT id, 6378137 * sqrt(cc - n * qq) / n * sin(n * (lon - radians(-96))) AS x,
        6378137 * sqrt(cc - n * q0) / n - 6378137 * sqrt(cc - n * qq) / n * cos(n * (lon - radians(-96))) AS y
      FROM (SELECT id, lon, {_Q} AS qq, cc, n, q0 FROM r, (SELECT c_custkey AS id, radians({b.US_LON}) AS lon, radians({b.US_LAT}) AS lat FROM customer))),
    sides AS (SELECT id, geoid, x, y, x1, y1, x2 - x1 AS u, y2 - y1 AS v, least(1.0, greatest(0.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t
      FROM pts, corners),
    dist AS (SELECT id, geoid, CASE WHEN min(u * (y - y1) - v * (x - x1)) > 0 THEN 0.0 ELSE min(sqrt(pow(x - x1 - t * u, 2) + pow(y - y1 - t * v, 2))) END AS d FROM sides GROUP BY id, geoid)
    SELECT id, geoid, round(d, 1) AS distance_m, CAST(row_number() OVER (PARTITION BY id ORDER BY d, geoid) AS INT) AS rank FROM dist
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, geoid) <= 5""")
def nearest_in_metres(spark, sf):
    """The five nearest counties of a year, at any distance, from longitudes and latitudes."""
    points = b.spread(b.read(spark, sf, "customer")).selectExpr("c_custkey AS id", f"{b.US_LON} AS lon", f"{b.US_LAT} AS lat")
    county, cd = (_lonlat(spark, sf, kind).withColumn("boundary_type", F.lit(kind)) for kind in ("county", "cd"))
    older = county.withColumns({"vintage_year": F.lit(2010), "geoid": F.concat(F.lit("x"), "geoid")})
    out = serving.boundaries_near(points, county.unionByName(cd).unionByName(older), boundary_type="county", year=2020, limit=5)
    return out.select("id", "geoid", F.round("distance_m", 1).alias("distance_m"), "rank")


@query(
    b.with_edges("county")
    + """, m AS (SELECT summary_level, geoid, abs(sum(x1 * y2 - x2 * y1)) / 2 AS a, sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))) AS p FROM edges GROUP BY ALL)
    SELECT summary_level, geoid, round(a, 6) AS area, round(p, 6) AS perimeter, round(4 * pi() * a / (p * p), 6) AS polsby_popper FROM m"""
)
def boundary_measures(spark, sf):
    """Area, perimeter and compactness through the session's SQL functions."""
    register_functions(spark)
    shapes = b.boundary_texts(spark, sf, "county").selectExpr("summary_level", "geoid", "st_geomfromwkt(wkt) AS rings")
    return shapes.selectExpr(
        "summary_level", "geoid", "round(st_area(rings), 6) AS area", "round(st_perimeter(rings), 6) AS perimeter",
        "round(st_polsbypopper(rings), 6) AS polsby_popper",
    )


@query(f"""SELECT geoid, round((x1 - x0) * (y1 - y0) / (pi() * (pow(x1 - x0, 2) + pow(y1 - y0, 2)) / 4), 6) AS reock FROM ({_box_rows('vtd')})""")
def reock_compactness(spark, sf):
    return reock_scores(_boxes(spark, sf, "vtd"), "geoid").select("geoid", F.round("reock", 6).alias("reock"))


_DISTRICTS = "FROM (SELECT *, CAST(substr(geoid, 2) AS BIGINT) AS pop, x1 - x0 AS w, y1 - y0 AS h, substr(geoid, 11) AS plan FROM ({boxes}))"


@query(
    "SELECT geoid, round((pop - avg(pop) OVER (PARTITION BY plan)) / nullif(avg(pop) OVER (PARTITION BY plan), 0) * 100, 6) AS deviation_pct, "
    "round(4 * pi() * w * h / pow(2 * (w + h), 2), 6) AS polsby_popper, round(w * h / (pi() * (w * w + h * h) / 4), 6) AS reock "
    + _DISTRICTS.format(boxes=_box_rows("vtd"))
)
def plan_district_facts(spark, sf):
    """Population deviation within each plan and both compactness scores."""
    districts = _boxes(spark, sf, "vtd").withColumns(
        {"total_population": F.substring("geoid", 2, 20).cast("bigint"), "plan": F.expr("substr(geoid, 11)")}
    )
    facts = warehouse.redistricting_plan_facts(districts, ["plan"])
    return facts.select("geoid", *[F.round(c, 6).alias(c) for c in ("deviation_pct", "polsby_popper", "reock")])


def _albers_check() -> str:
    return f"""{_PROJECTIONS},
    pts AS (SELECT c_custkey AS id, radians({b.US_LON}) AS lon, radians({b.US_LAT}) AS lat FROM customer),
    w AS (SELECT pts.*, r.*, {_Q} AS qq,
        tan(pi() / 4 - lat / 2) / pow((1 - e * sin(lat)) / (1 + e * sin(lat)), e / 2) AS tt FROM pts, r)
    SELECT id, round(6378137 * sqrt(cc - n * qq) / n * sin(n * (lon - radians(-96))), 3) AS albers_x,
        round(6378137 * sqrt(cc - n * q0) / n - 6378137 * sqrt(cc - n * qq) / n * cos(n * (lon - radians(-96))), 3) AS albers_y,
        round(6378137 * ff * pow(tt, ln_) * sin(ln_ * (lon - radians(-79.5))), 3) AS lambert_x,
        round(6378137 * ff * pow(t0, ln_) - 6378137 * ff * pow(tt, ln_) * cos(ln_ * (lon - radians(-79.5))), 3) AS lambert_y FROM w"""


@query(_albers_check())
def projected_addresses(spark, sf):
    pts = b.read(spark, sf, "customer").selectExpr("c_custkey AS id", f"{b.US_LON} AS lon", f"{b.US_LAT} AS lat")
    both = pts.selectExpr("id", f"{p.albers('lon', 'lat')} AS a", f"{p.lambert('lon', 'lat')} AS l")
    return both.selectExpr(
        "id", "round(a.x, 3) AS albers_x", "round(a.y, 3) AS albers_y", "round(l.x, 3) AS lambert_x", "round(l.y, 3) AS lambert_y"
    )


@query(
    b.with_edges("tract")
    + """ SELECT concat('{"type":"Feature","geometry":{"type":"MultiPolygon","coordinates":[[[', string_agg(concat('[', CAST(x1 AS VARCHAR), ',', CAST(y1 AS VARCHAR), ']'), ',' ORDER BY k),
    ']]]},"properties":{"geoid":"', geoid, '","summary_level":"tract"}}') AS feature FROM (
      SELECT geoid, x1, y1, 0 AS k, row_number() OVER () AS o FROM edges WHERE false
      UNION ALL SELECT geoid, x, y, k, 0 FROM (SELECT geoid, min(x1) AS xa, max(x1) AS xb, min(y1) AS ya, max(y1) AS yb FROM edges GROUP BY geoid),
      LATERAL (VALUES (xa, ya, 0), (xb, ya, 1), (xb, yb, 2), (xa, yb, 3), (xa, ya, 4)) v(x, y, k)) GROUP BY geoid"""
)
def boundary_features(spark, sf):
    return geojson.features(b.boundaries(spark, sf, "tract"), ["geoid", "summary_level"]).select("feature")


# --- Hulls and clusters ---

# Voters in blocks of 450 x 450 m, dense enough for clusters and noise.
_CX = f"{b._d('(c_custkey * c_custkey * 7919 + c_custkey * 31) % 1499')} * {b._d('0.3')} + 1000 * CAST(floor(c_custkey / 1500) AS INT)"
_CY = f"{b._d('(c_custkey * c_custkey * 104729 + c_custkey * 77) % 1493')} * {b._d('0.3')}"
_VOTERS = (
    f"SELECT c_custkey AS vanid, {_CX} AS x, {_CY} AS y, CASE WHEN c_custkey % 5 = 4 THEN 'Other' ELSE 'African-American ' END AS racename, "
    "40 + CAST(c_custkey % 60 AS INT) AS age, CAST(c_nationkey % 3 AS VARCHAR(9)) AS cd, c_mktsegment AS precinctname FROM {customer}"
)


def _cluster_check(group: str, eps: float, tail: str) -> str:
    return f"""WITH RECURSIVE v AS ({_VOTERS.format(customer='customer')}), f AS (SELECT *, concat({group}, '') AS grp FROM v WHERE trim(racename) = 'African-American' AND age > 50),
    nb AS (SELECT a.vanid AS a, b.vanid AS b FROM f a JOIN f b ON a.grp = b.grp AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= {eps * eps}),
    core AS (SELECT a AS id FROM nb GROUP BY a HAVING count(*) >= 5),
    link AS (SELECT a, b FROM nb WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
    reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
    comp AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY a),
    allc AS (SELECT id, c FROM comp UNION ALL SELECT nb.a, min(comp.c) FROM nb JOIN comp ON comp.id = nb.b WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY nb.a),
    lab AS (SELECT f.vanid, f.grp, f.cd, f.precinctname, allc.c FROM f JOIN allc ON allc.id = f.vanid),
    num AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY grp ORDER BY c) - 1 AS BIGINT) AS k FROM lab) {tail}"""


def _voters(spark, sf):
    return b.sql(spark, sf, _VOTERS, "customer")


@query(_cluster_check("'all'", 20, """SELECT v.vanid, CASE WHEN f.vanid IS NULL THEN NULL ELSE coalesce(k, -1) END AS cluster_id
    FROM v LEFT JOIN f ON f.vanid = v.vanid LEFT JOIN num ON num.vanid = v.vanid"""))
def voter_clusters(spark, sf):
    return clustering.statewide_clusters(_voters(spark, sf)).select("vanid", "cluster_id")


_LABELS = """SELECT v.vanid, coalesce(num.cd || '-' || num.precinctname || '-' || CAST(k AS VARCHAR), '-1') AS label FROM v LEFT JOIN num ON num.vanid = v.vanid"""


@query(_cluster_check("cd", 25, _LABELS))
def voter_clusters_by_district(spark, sf):
    out = clustering.grouped_clusters(_voters(spark, sf), "cluster_id_within_cd", eps=25.0)
    return out.select("vanid", F.col("cluster_id_within_cd").alias("label"))


@query(_cluster_check("concat(cd, '|', precinctname)", 60, _LABELS))
def voter_clusters_by_precinct(spark, sf):
    out = clustering.grouped_clusters(_voters(spark, sf), "cluster_id_within_cd_and_precinct", eps=60.0)
    return out.select("vanid", F.col("cluster_id_within_cd_and_precinct").alias("label"))


@query(_cluster_check("cd", 25, "SELECT concat(cd, '-', precinctname, '-', CAST(k AS VARCHAR)) AS label, count(*) AS total_voters FROM num GROUP BY 1"))
def voter_cluster_sizes(spark, sf):
    voters = spool(clustering.grouped_clusters(_voters(spark, sf), "cluster_id_within_cd", eps=25.0), "voters")
    return clustering.cluster_sizes(voters, "cluster_id_within_cd").withColumnRenamed("cluster_id_within_cd", "label")


# Whole-number positions, so that points on one line are on one line exactly.
_HULL_POINTS = f"SELECT c_nationkey AS k, {b._d('c_custkey * 7919 % 36000')} AS x, {b._d('c_custkey * 104729 % 18000')} AS y FROM {{customer}}"


@query(
    f"""WITH pts AS (SELECT DISTINCT * FROM ({_HULL_POINTS.format(customer='customer')})),
    e AS (SELECT a.k, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM pts a JOIN pts b ON a.k = b.k AND (a.x <> b.x OR a.y <> b.y)
    WHERE NOT EXISTS (SELECT 1 FROM pts c WHERE c.k = a.k AND ((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) < 0
      OR ((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) = 0 AND (c.x - a.x) * (c.x - b.x) + (c.y - a.y) * (c.y - b.y) > 0))))
    SELECT k, round(sum(x1 * y2 - x2 * y1) / 2, 4) AS area, count(*) AS vertices FROM e GROUP BY k"""
)
def convex_hull_areas(spark, sf):
    """Hull of each nation's addresses, by its area and number of corners."""
    hulls = convex_hulls(b.sql(spark, sf, _HULL_POINTS, "customer"), ["k"])
    return hulls.select("k", F.expr(f"round({g.area('rings')}, 4)").alias("area"), (F.size(F.col("rings")[0]) - 1).cast("bigint").alias("vertices"))


@query(f"SELECT c_mktsegment AS label, CAST(row_number() OVER (ORDER BY c_mktsegment) AS BIGINT) AS gid FROM customer WHERE c_mktsegment <> '-1' GROUP BY 1")
def numbered_hulls(spark, sf):
    points = b.addresses(spark, sf).withColumnRenamed("c_mktsegment", "label")
    return clustering.cluster_hulls(points, "label").select("label", "gid")


_MATCHES = b.with_hits("state") + (
    ", flagged AS (SELECT a.id, a.c_mktsegment, count(h.id) > 0 AS ok FROM addr a JOIN nation n ON n.n_nationkey = a.c_nationkey "
    "LEFT JOIN hits h ON h.id = a.id AND h.name = n.n_name GROUP BY ALL)"
)


def _flagged(spark, sf):
    named = b.sql(spark, sf, f"SELECT a.*, n_name AS label FROM ({b.ADDRESSES}) a JOIN {{nation}} ON n_nationkey = c_nationkey", "customer", "nation")
    return label_matches_space(named, b.boundaries(spark, sf, "state"), label="label", name="name", id_col="id", flag="ok")


@query(_MATCHES + " SELECT ok, count(*) AS total_voters FROM flagged GROUP BY ok")
def label_match_counts(spark, sf):
    return clustering.label_match_counts(_flagged(spark, sf), "ok")


@query(
    _MATCHES
    + " SELECT c_mktsegment, count(*) FILTER (WHERE ok) AS state_label_matches, count(*) FILTER (WHERE NOT ok) AS state_label_does_not_match FROM flagged GROUP BY 1"
)
def label_match_by_group(spark, sf):
    return clustering.label_match_by_race(_flagged(spark, sf), "ok", "c_mktsegment")


@query(_MATCHES + " SELECT id FROM flagged WHERE ok")
def matching_voters_kept(spark, sf):
    return _flagged(spark, sf).filter("ok").select("id")

"""Planar geometry as Spark SQL expressions.

Each function takes SQL expression texts and returns one, so that the same
definition serves DataFrame code (`F.expr`) and the session's SQL functions
(`functions.registry`). Everything stays a native expression.

A point is `struct<x,y>`. A polygon or multipolygon is `rings`, an
`array<array<struct<x,y>>>` of closed rings: shells counter-clockwise, holes
clockwise, so that the signed areas add up. Inside is even-odd, half-open: a
point on an edge shared by two polygons falls in exactly one of them.
"""

from __future__ import annotations

POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"
RINGS = f"ARRAY<ARRAY<{POINT}>>"
EDGE = "STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>"


def point(x: str, y: str) -> str:
    return f"named_struct('x', CAST({x} AS DOUBLE), 'y', CAST({y} AS DOUBLE))"


def ring_area(ring: str) -> str:
    """Signed area, positive when counter-clockwise."""
    return (
        f"aggregate(transform(slice({ring}, 2, greatest(size({ring}), 1)), (ra_p, ra_i) -> "
        f"{ring}[ra_i].x * ra_p.y - ra_p.x * {ring}[ra_i].y), 0D, (ra_s, ra_v) -> ra_s + ra_v) / 2"
    )


def oriented(polygons: str) -> str:
    """Rings from an array of polygons (shell first), each turned the right way."""
    return (
        f"flatten(transform({polygons}, op_poly -> transform(op_poly, (op_r, op_k) -> "
        f"CASE WHEN ({ring_area('op_r')} > 0) = (op_k = 0) THEN op_r ELSE reverse(op_r) END)))"
    )


def geometry_type(wkt: str) -> str:
    """`ST_` plus the type name in its usual spelling."""
    tag = f"upper(regexp_extract({wkt}, '^\\\\s*(?:SRID=\\\\d+;)?\\\\s*([A-Za-z]+)', 1))"
    return (
        f"concat('ST_', CASE {tag} WHEN 'POINT' THEN 'Point' WHEN 'POLYGON' THEN 'Polygon' "
        f"WHEN 'MULTIPOLYGON' THEN 'MultiPolygon' WHEN 'LINESTRING' THEN 'LineString' "
        f"WHEN 'MULTILINESTRING' THEN 'MultiLineString' WHEN 'MULTIPOINT' THEN 'MultiPoint' "
        f"WHEN 'GEOMETRYCOLLECTION' THEN 'GeometryCollection' END)"
    )


def _wkt_body(wkt: str) -> str:
    head = "'^[^(]*\\\\(+\\\\s*'"
    tail = "'\\\\s*\\\\)+\\\\s*$'"
    return f"regexp_replace(regexp_replace({wkt}, {head}, ''), {tail}, '')"


def _wkt_point(text: str) -> str:
    parts = f"split(trim({text}), '\\\\s+')"
    return f"named_struct('x', try_cast({parts}[0] AS DOUBLE), 'y', try_cast({parts}[1] AS DOUBLE))"


def rings_from_wkt(wkt: str) -> str:
    """Rings of a POLYGON or MULTIPOLYGON text; null for any other text."""
    between_polygons = "'\\\\)\\\\s*\\\\)\\\\s*,\\\\s*\\\\(\\\\s*\\\\('"
    between_rings = "'\\\\)\\\\s*,\\\\s*\\\\('"
    polygons = (
        f"transform(split({_wkt_body(wkt)}, {between_polygons}), w_poly -> "
        f"transform(split(w_poly, {between_rings}), w_ring -> "
        f"transform(split(w_ring, ','), w_pt -> {_wkt_point('w_pt')})))"
    )
    return (
        f"CASE WHEN {wkt} RLIKE '(?i)^\\\\s*(SRID=\\\\d+;)?\\\\s*(MULTI)?POLYGON\\\\s*Z?\\\\s*\\\\(' "
        f"THEN {oriented(polygons)} END"
    )


def point_from_wkt(wkt: str) -> str:
    return (
        f"CASE WHEN {wkt} RLIKE '(?i)^\\\\s*(SRID=\\\\d+;)?\\\\s*POINT\\\\s*Z?\\\\s*\\\\(' "
        f"THEN {_wkt_point(_wkt_body(wkt))} END"
    )


def edges(rings: str) -> str:
    """All directed edges as one flat array."""
    return (
        f"flatten(transform({rings}, ed_r -> transform(slice(ed_r, 2, greatest(size(ed_r), 1)), "
        f"(ed_p, ed_i) -> named_struct('x1', ed_r[ed_i].x, 'y1', ed_r[ed_i].y, 'x2', ed_p.x, 'y2', ed_p.y))))"
    )


def crosses_ray(e: str, px: str, py: str) -> str:
    """Whether edge `e` crosses the ray from the point towards larger x."""
    return (
        f"(({e}.y1 > {py}) != ({e}.y2 > {py}) AND "
        f"{px} < ({e}.x2 - {e}.x1) * ({py} - {e}.y1) / nullif({e}.y2 - {e}.y1, 0D) + {e}.x1)"
    )


def inside_edges(edge_array: str, px: str, py: str) -> str:
    return f"size(filter({edge_array}, ie_e -> {crosses_ray('ie_e', px, py)})) % 2 = 1"


def contains(rings: str, px: str, py: str) -> str:
    return inside_edges(edges(rings), px, py)


def area(rings: str) -> str:
    return f"abs(aggregate(transform({rings}, ar_r -> {ring_area('ar_r')}), 0D, (ar_s, ar_v) -> ar_s + ar_v))"


def perimeter(rings: str) -> str:
    return (
        f"aggregate({edges(rings)}, 0D, (pe_s, pe_e) -> "
        f"pe_s + sqrt(pow(pe_e.x2 - pe_e.x1, 2) + pow(pe_e.y2 - pe_e.y1, 2)))"
    )


def polsby_popper(rings: str) -> str:
    return f"4 * pi() * {area(rings)} / nullif(pow({perimeter(rings)}, 2), 0D)"


def extent(rings: str) -> str:
    """Bounding box struct."""
    xs, ys = f"flatten({rings}).x", f"flatten({rings}).y"
    return (
        f"named_struct('minx', array_min({xs}), 'miny', array_min({ys}), "
        f"'maxx', array_max({xs}), 'maxy', array_max({ys}))"
    )


def segment_distance(e: str, px: str, py: str) -> str:
    """Distance from the point to the nearest place on edge `e`."""
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    t = (
        f"least(1D, greatest(0D, coalesce((({px} - {e}.x1) * {dx} + ({py} - {e}.y1) * {dy}) "
        f"/ nullif({dx} * {dx} + {dy} * {dy}, 0D), 0D)))"
    )
    return f"sqrt(pow({px} - {e}.x1 - {t} * {dx}, 2) + pow({py} - {e}.y1 - {t} * {dy}, 2))"


def distance(rings: str, px: str, py: str) -> str:
    """Distance from the point to the polygon, 0 inside it."""
    return (
        f"CASE WHEN {contains(rings, px, py)} THEN 0D ELSE "
        f"array_min(transform({edges(rings)}, di_e -> {segment_distance('di_e', px, py)})) END"
    )


def _side(e: str, px: str, py: str) -> str:
    return f"sign(({e}.x2 - {e}.x1) * ({py} - {e}.y1) - ({e}.y2 - {e}.y1) * ({px} - {e}.x1))"


def intersects(rings_a: str, rings_b: str) -> str:
    """Whether two polygons share a place: edges that meet, or one inside the other."""
    meet = (
        "greatest(is_a.x1, is_a.x2) >= least(is_b.x1, is_b.x2) AND "
        "least(is_a.x1, is_a.x2) <= greatest(is_b.x1, is_b.x2) AND "
        "greatest(is_a.y1, is_a.y2) >= least(is_b.y1, is_b.y2) AND "
        "least(is_a.y1, is_a.y2) <= greatest(is_b.y1, is_b.y2) AND "
        f"{_side('is_a', 'is_b.x1', 'is_b.y1')} * {_side('is_a', 'is_b.x2', 'is_b.y2')} <= 0 AND "
        f"{_side('is_b', 'is_a.x1', 'is_a.y1')} * {_side('is_b', 'is_a.x2', 'is_a.y2')} <= 0"
    )
    first_a, first_b = f"{rings_a}[0][0]", f"{rings_b}[0][0]"
    return (
        f"(exists({edges(rings_a)}, is_a -> exists({edges(rings_b)}, is_b -> {meet})) "
        f"OR {contains(rings_b, first_a + '.x', first_a + '.y')} "
        f"OR {contains(rings_a, first_b + '.x', first_b + '.y')})"
    )


def point_on_surface(rings: str) -> str:
    """Interior label point: the middle of the widest inside span on a scan line.

    The line runs halfway between the two vertex heights around the middle of
    the extent, so it never touches a vertex.
    """
    ys = f"array_sort(array_distinct(flatten({rings}).y))"
    mid = f"(array_min(flatten({rings}).y) + array_max(flatten({rings}).y)) / 2"
    above = f"array_min(filter({ys}, ps_y -> ps_y > {mid}))"
    below = f"array_max(filter({ys}, ps_y -> ps_y <= {mid}))"
    line = f"({above} + {below}) / 2"
    hits = (
        f"array_sort(transform(filter({edges(rings)}, ps_e -> (ps_e.y1 > ps_l) != (ps_e.y2 > ps_l)), "
        f"ps_e -> (ps_e.x2 - ps_e.x1) * (ps_l - ps_e.y1) / (ps_e.y2 - ps_e.y1) + ps_e.x1))"
    )
    spans = (
        "transform(filter(transform(ps_h, (ps_x, ps_i) -> named_struct('w', ps_h[ps_i + 1] - ps_x, "
        "'m', (ps_h[ps_i + 1] + ps_x) / 2, 'k', ps_i)), ps_s -> ps_s.k % 2 = 0 AND ps_s.w IS NOT NULL), "
        "ps_s -> named_struct('w', ps_s.w, 'm', ps_s.m))"
    ).replace("ps_h[ps_i + 1]", "get(ps_h, ps_i + 1)")
    at_line = f"transform(array({hits}), ps_h -> named_struct('x', array_max({spans}).m, 'y', ps_l))[0]"
    return f"transform(array({line}), ps_l -> {at_line})[0]"


def geojson(rings: str) -> str:
    """GeoJSON MultiPolygon text; each shell opens a polygon and takes the holes that follow it."""
    ring = "transform(gj_r, gj_p -> array(gj_p.x, gj_p.y))"
    grouped = (
        f"aggregate({rings}, CAST(array() AS ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>), (gj_acc, gj_r) -> "
        f"CASE WHEN {ring_area('gj_r')} >= 0 OR size(gj_acc) = 0 THEN concat(gj_acc, array(array({ring}))) "
        f"ELSE concat(slice(gj_acc, 1, greatest(size(gj_acc) - 1, 0)), "
        f"array(concat(element_at(gj_acc, -1), array({ring})))) END)"
    )
    return f"to_json(named_struct('type', 'MultiPolygon', 'coordinates', {grouped}))"

"""Civic tables derived from the general test tables.

The row expressions are written once, in SQL both engines read, and used for
the Spark frames as well as in the check queries. Only inputs are shared this
way; what the operators compute is stated separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.boundaries import with_rings


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The same rows over a few partitions for each core: tables of few bytes come as one or two, however much work a row is."""
    parts = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts)


def sql(spark: SparkSession, sf_dir: str, text: str, *tables: str) -> DataFrame:
    """`text` over the named tables, given to it as arguments rather than session views."""
    return spark.sql(text, **{t: read(spark, sf_dir, t) for t in tables})


def _d(text: str) -> str:
    return f"CAST({text} AS DOUBLE)"


# Positions all over a plane of 360 x 180 degrees.
ADDRESS_X = f"-180 + {_d('c_custkey * 7919 % 36000')} / {_d('100')} + {_d('0.003')}"
ADDRESS_Y = f"-90 + {_d('c_custkey * 104729 % 18000')} / {_d('100')} + {_d('0.003')}"
ADDRESSES = f"SELECT c_custkey AS id, {ADDRESS_X} AS x, {ADDRESS_Y} AS y, c_nationkey, c_mktsegment FROM {{customer}}"

# Positions within the conterminous states, for the projections.
US_LON = f"-120 + {_d('c_custkey * 7919 % 5000')} / {_d('100')}"
US_LAT = f"26 + {_d('c_custkey * 104729 % 2200')} / {_d('100')}"


def pad(text: str, width: int) -> str:
    return f"lpad(CAST({text} AS VARCHAR(20)), {width}, '0')"


# Lower left corner of a nation's tile in a 5 x 5 grid.
_X0 = "(-180 + 72 * (n_nationkey % 5))"
_Y0 = "(-90 + 36 * CAST(floor(n_nationkey / 5) AS INT))"
_SX = "(-180 + 72 * (s_nationkey % 5) + 6 + CAST(s_suppkey * 37 % 60 AS INT))"
_SY = "(-90 + 36 * CAST(floor(s_nationkey / 5) AS INT) + 5 + CAST(s_suppkey * 53 % 25 AS INT))"
_SR = "(2 + CAST(s_suppkey % 5 AS INT))"
_PX = "(-176 + CAST(p_partkey * 7919 % 352 AS INT))"
_PY = "(-86 + CAST(p_partkey * 10473 % 172 AS INT))"
_PR = "(1 + CAST(p_partkey % 3 AS INT))"
_RY = "(-90 + 36 * r_regionkey)"

# Level -> (table, geoid, name, state code, rings of each part as (x, y) texts, shell first).
SHAPES = {
    "state": (
        "nation", pad("n_nationkey", 2), "n_name", pad("n_nationkey", 2),
        [[[(f"{_X0} + 1", f"{_Y0} + 1 + n_nationkey % 3"), (f"{_X0} + 70 - n_nationkey % 4", f"{_Y0} + 2"),
           (f"{_X0} + 71", f"{_Y0} + 20 + n_nationkey % 5"), (f"{_X0} + 36", f"{_Y0} + 35"),
           (f"{_X0} + 2", f"{_Y0} + 30 - n_nationkey % 6")]]],
    ),
    "county": (
        "supplier", f"concat({pad('s_nationkey', 2)}, {pad('s_suppkey', 6)})", "s_name", pad("s_nationkey", 2),
        [[[(f"{_SX} - {_SR}", f"{_SY} - {_SR}"), (f"{_SX} + {_SR}", f"{_SY} - {_SR}"), (f"{_SX} + {_SR} + 1", f"{_SY} + 1"),
           (f"{_SX}", f"{_SY} + {_SR}"), (f"{_SX} - {_SR}", f"{_SY} + 1")]]],
    ),
    "tract": (
        "part", pad("p_partkey", 11), "p_name", "'00'",
        [[[(f"{_PX} - {_PR}", f"{_PY} - {_PR}"), (f"{_PX} + {_PR}", f"{_PY} - {_PR}"), (f"{_PX} + {_PR}", f"{_PY} + {_PR}"),
           (f"{_PX} - {_PR}", f"{_PY} + {_PR}")]]],
    ),
    "vtd": (
        "part", f"concat('V', {pad('p_partkey', 10)})", "p_name", "'00'",
        [[[(f"{_PX} - {_PR} - 1", f"{_PY} - {_PR}"), (f"{_PX} + {_PR}", f"{_PY} - {_PR} - 1"), (f"{_PX}", f"{_PY} + {_PR} + 1")]]],
    ),
    "cd": (
        "region", pad("r_regionkey", 4), "r_name", "'00'",
        [
            [[("-179", f"{_RY} + 1"), ("-1", f"{_RY} + 1"), ("-1", f"{_RY} + 35"), ("-179", f"{_RY} + 35")],
             [("-120", f"{_RY} + 10"), ("-60", f"{_RY} + 10"), ("-60", f"{_RY} + 20"), ("-120", f"{_RY} + 20")]],
            [[("1", f"{_RY} + 1"), ("179", f"{_RY} + 1"), ("170", f"{_RY} + 34"), ("1", f"{_RY} + 34")]],
        ],
    ),
}


def _wkt(parts) -> str:
    def ring(vertices):
        cells = []
        for x, y in [*vertices, vertices[0]]:
            cells.append(f"CAST({x} AS STRING), ' ', CAST({y} AS STRING)")
        return "'(', " + ", ', ', ".join(cells) + ", ')'"

    polygons = ["'(', " + ", ', ', ".join(ring(r) for r in rings) + ", ')'" for rings in parts]
    if len(parts) == 1:
        return f"concat('POLYGON ', {polygons[0]})"
    return "concat('MULTIPOLYGON (', " + ", ', ', ".join(polygons) + ", ')')"


def boundary_texts(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    """Boundaries with their shape as WKT: geoid, name, summary_level, vintage_year, state_fips, wkt."""
    out = None
    for level in levels or SHAPES:
        table, geoid, name, state, parts = SHAPES[level]
        df = spread(read(spark, sf_dir, table)).selectExpr(
            f"{geoid} AS geoid", f"{name} AS name", f"'{level}' AS summary_level", "2020 AS vintage_year",
            f"{state} AS state_fips", f"{_wkt(parts)} AS wkt",
        )
        out = df if out is None else out.unionByName(df)
    return out


def boundaries(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    return with_rings(boundary_texts(spark, sf_dir, *levels))


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ADDRESSES, customer=spread(read(spark, sf_dir, "customer")))


# --- The same inputs as common table expressions for the check queries ---


def _edge_rows(level: str) -> str:
    table, geoid, name, state, parts = SHAPES[level]
    edges = []
    for rings in parts:
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
                edges.append(f"{{'x1': {_d(x1)}, 'y1': {_d(y1)}, 'x2': {_d(x2)}, 'y2': {_d(y2)}}}")
    return (
        f"SELECT geoid, name, summary_level, state_fips, e.x1, e.y1, e.x2, e.y2 FROM (SELECT {geoid} AS geoid, {name} AS name, "
        f"'{level}' AS summary_level, {state} AS state_fips, unnest([{', '.join(edges)}]) AS e FROM {table})"
    )


def with_edges(*levels: str) -> str:
    """`addr` and `edges` (one row per directed edge) of the levels."""
    rows = " UNION ALL ".join(_edge_rows(level) for level in levels)
    return f"WITH RECURSIVE addr AS ({ADDRESSES.format(customer='customer')}), edges AS ({rows})"


def with_hits(*levels: str) -> str:
    """`with_edges` plus `hits`: every address and boundary around it, by crossing parity."""
    return with_edges(*levels) + (
        ", hits AS (SELECT p.id, e.geoid, e.name, e.summary_level FROM addr p JOIN edges e "
        "ON (e.y1 > p.y) <> (e.y2 > p.y) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1 "
        "GROUP BY ALL HAVING count(*) % 2 = 1)"
    )

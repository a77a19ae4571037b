"""Lookup queries: lists, pages, search, boundaries of points, overlaps, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.history import latest_per_key
from plumbline.operators.pip import point_in_polygon, shape_columns
from plumbline.operators.proximity import in_metres, k_nearest

# Boundary types, and those looked up when none are named.
BOUNDARY_TYPES = [
    "state", "county", "tract", "place", "zcta", "cd", "state_leg_upper", "state_leg_lower", "vtd", "timezone",
]
DEFAULT_TYPES = ["state", "county", "cd", "state_leg_upper", "state_leg_lower", "tract", "timezone"]

# Attributes a boundary can show.
ATTRIBUTES = [
    "geoid", "name", "vintage_year", "abbreviation", "state_fips", "district_number", "congress_number",
    "timezone_id", "utc_offset_std", "area_land", "area_water",
]

# Default and largest page sizes.
PAGE_SIZES = {"json": (100, 1000), "geojson": (50, 500)}

# Columns each list may be ordered by, its default first.
ORDERINGS = {
    "geography": ["geoid", "name", "vintage_year"],
    "acs_estimate": ["-estimate", "estimate"],
    "election_result": ["-votes", "votes", "vote_share"],
}


def boundary_list(
    boundaries: DataFrame,
    *,
    year: int | None = None,
    state_fips: str | None = None,
    geoid: str | None = None,
    geoid_prefix: str | None = None,
) -> DataFrame:
    out = boundaries
    if year:
        out = out.filter(F.col("vintage_year") == year)
    if state_fips and "state_fips" in boundaries.columns:
        out = out.filter(F.col("state_fips") == state_fips)
    if geoid:
        out = out.filter(F.col("geoid") == geoid)
    if geoid_prefix:
        out = out.filter(F.col("geoid").startswith(geoid_prefix))
    return out


def attributes(boundaries: DataFrame, include_geometry: bool = False) -> DataFrame:
    """The known attributes the table has, and the shape when asked for."""
    keep = [c for c in ATTRIBUTES if c in boundaries.columns]
    if include_geometry and "rings" in boundaries.columns:
        keep.append("rings")
    return boundaries.select(*keep)


def boundary_detail(boundaries: DataFrame, geoid: str, year: int | None = None) -> DataFrame:
    """One boundary with its shape: the given year's or the newest version."""
    rows = boundary_list(boundaries, geoid=geoid, year=year)
    return attributes(latest_per_key(rows, ["geoid"], ["vintage_year"]), include_geometry=True)


def search(df: DataFrame, query: str, columns: tuple[str, ...] = ("name", "geoid")) -> DataFrame:
    """Rows with the query text anywhere in one of the columns, whatever the case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(c), F.lit(query.lower()))
    return df.filter(hit)


def ordered(df: DataFrame, listing: str, by: str | None = None, unique: tuple[str, ...] = ()) -> DataFrame:
    """Sorted by an allowed column (`-` for descending); `unique` columns settle ties."""
    allowed = ORDERINGS[listing]
    by = by if by is not None and by.lstrip("-") in {a.lstrip("-") for a in allowed} else allowed[0]
    column = F.col(by.lstrip("-"))
    return df.orderBy(column.desc() if by.startswith("-") else column.asc(), *unique)


def page(df: DataFrame, order: list, number: int = 1, size: int | None = None, kind: str = "json") -> DataFrame:
    """One page in the given order; a size above the limit of its kind is an error."""
    default, largest = PAGE_SIZES[kind]
    size = size or default
    if size > largest:
        raise ValueError(f"a {kind} page has at most {largest} rows, not {size}")
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def boundaries_of_points(
    points: DataFrame,
    boundaries: DataFrame,
    *,
    id_col: str = "id",
    types: list[str] | None = None,
    year: int | None = None,
    date: str | None = None,
) -> DataFrame:
    """`(id, boundary_type, geoid, name, vintage_year)`: the boundary of each type around each point.

    Unknown types are skipped; `year` beats `date`, which needs effective_from
    and effective_to. Several boundaries of a type give the smallest geoid.
    """
    wanted = [t for t in (DEFAULT_TYPES if types is None else types) if t in BOUNDARY_TYPES]
    shapes = boundaries.filter(F.col("boundary_type").isin(wanted))
    if year:
        shapes = shapes.filter(F.col("vintage_year") == year)
    elif date:
        d = F.lit(date).cast("date")
        shapes = shapes.filter(
            (F.col("effective_from").isNull() | (F.col("effective_from") <= d))
            & (F.col("effective_to").isNull() | (F.col("effective_to") >= d))
        )
    shapes = shapes.select("boundary_type", "geoid", "name", "vintage_year", *shape_columns(shapes))
    first = F.struct("geoid", "vintage_year", "name")
    hits = point_in_polygon(points.select(id_col, "x", "y"), shapes, id_col=id_col, least=first, least_by=("boundary_type",))
    return hits.groupBy(id_col, "boundary_type").agg(F.min(first).alias("_b")).select(id_col, "boundary_type", "_b.geoid", "_b.name", "_b.vintage_year")


def boundaries_near(
    points: DataFrame,
    boundaries: DataFrame,
    *,
    boundary_type: str,
    year: int | None = None,
    max_distance: float | None = None,
    limit: int = 20,
    id_col: str = "id",
    lon: str = "lon",
    lat: str = "lat",
) -> DataFrame:
    """`(id, geoid, distance_m, rank)`: the nearest boundaries of a type, in metres, from longitudes and latitudes.

    Without `year` every vintage takes part; versions of one geoid are then
    told apart by `vintage_year`, which comes along.
    """
    if boundary_type not in BOUNDARY_TYPES:
        raise ValueError(f"unknown boundary type {boundary_type!r}; one of {sorted(BOUNDARY_TYPES)}")
    shapes = boundaries.filter(F.col("boundary_type") == boundary_type)
    if year:
        shapes = shapes.filter(F.col("vintage_year") == year)
    placed, shapes = in_metres(points, shapes.withColumn("_key", F.struct("geoid", "vintage_year")), lon=lon, lat=lat)
    found = k_nearest(placed, shapes, id_col=id_col, key="_key", limit=limit, max_distance=max_distance)
    return found.select(id_col, "_key.*", "distance_m", "rank")


def overlaps_of(intersections: DataFrame, source_type: str, source_id: str | None = None, year: int | None = None) -> DataFrame:
    """Stored overlaps of a county or VTD with the districts, for one source or all."""
    key = f"{source_type}_geoid"
    out = intersections
    if source_id:
        out = out.filter(F.col(key) == source_id)
    if year:
        out = out.filter(F.col("year") == year)
    extra = ["relationship"] if "relationship" in intersections.columns else []
    return out.select(
        F.col(key).alias("source_id"),
        F.col("cd_geoid").alias("target_id"),
        F.col(f"pct_of_{source_type}").cast("double").alias("pct_of_source"),
        F.col("pct_of_cd").cast("double").alias("pct_of_cd"),
        "intersection_area_sqm",
        "is_dominant",
        *extra,
    )


def latest_snapshots(boundaries: DataFrame, snapshots: DataFrame, year: int | None = None) -> DataFrame:
    """Boundaries with their demographic snapshot of the year, or the newest one."""
    keys = ["boundary_type", "geoid"]
    rows = snapshots.filter(F.col("year") == year) if year else snapshots
    newest = latest_per_key(rows, keys, ["year"])
    values = ["year", "total_population", "median_household_income", "median_age"]
    return boundaries.join(newest.select(*keys, *values), keys)

"""Addresses placed in every boundary level, with the plan active on a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.pip import point_in_polygon, shape_columns
from plumbline.operators.temporal import plan_on_date, plan_windows

# Boundary levels and the address column each one fills.
LEVEL_COLUMNS = {
    "state": "state_geoid",
    "county": "county_geoid",
    "tract": "tract_geoid",
    "block_group": "block_group_geoid",
    "vtd": "vtd_geoid",
    "cd": "cd_geoid",
    "sldu": "sldu_geoid",
    "sldl": "sldl_geoid",
}

# Legislative chambers and the level each one's districts replace.
CHAMBER_LEVELS = {"congress": "cd", "state_senate": "sldu", "state_house": "sldl"}


def assignment_queue(
    addresses: DataFrame, state: str | None = None, source: str | None = None, force: bool = False, limit: int = 0
) -> DataFrame:
    """Geocoded addresses with a position that have no assignment yet (all of them with `force`)."""
    out = addresses.filter("geocoded AND latitude IS NOT NULL AND longitude IS NOT NULL")
    if not force:
        out = out.filter("census_units_assigned_at IS NULL")
    if state:
        out = out.filter(F.col("state_abbreviation") == state.upper())
    if source:
        out = out.filter(F.col("geocode_source") == source)
    return out.limit(limit) if limit else out


def top_states(addresses: DataFrame, n: int = 10) -> DataFrame:
    return (
        addresses.groupBy("state_abbreviation")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "state_abbreviation")
        .limit(n)
    )


def _known_first(name: str) -> Column:
    """Order in which the minimum is the first, nulls being passed over."""
    return F.struct(F.col(name).isNull().alias("missing"), F.col(name))


def level_geoids(
    points: DataFrame, boundaries: DataFrame, *, id_col: str = "id", x: str = "x", y: str = "y", on: tuple[str, ...] = (),
    levels: dict[str, str] | None = None, splits: int | None = None,
) -> DataFrame:
    """`(id, state_geoid, county_geoid, ...)`: one row per point that lies in any boundary.

    One join serves all levels; several containing boundaries of a level give the smallest geoid.
    """
    levels = levels or LEVEL_COLUMNS
    shapes = boundaries.filter(F.col("summary_level").isin(list(levels))).select("geoid", "summary_level", *on, *shape_columns(boundaries))
    hits = point_in_polygon(
        points.select(id_col, x, y, *on), shapes, x=x, y=y, on=on, id_col=id_col, splits=splits,
        least=_known_first("geoid"), least_by=("summary_level",),
    )
    return hits.groupBy(id_col).agg(
        *[F.min(F.when(F.col("summary_level") == k, F.col("geoid"))).alias(c) for k, c in levels.items()]
    )


def gated(levels: DataFrame) -> DataFrame:
    """A level counts only below a level that was found: county before tract and VTD, tract before block group."""
    county = F.col("county_geoid").isNotNull()
    tract = county & F.col("tract_geoid").isNotNull()
    gates = {"tract_geoid": county, "vtd_geoid": county, "block_group_geoid": tract}
    return levels.withColumns({c: F.when(cond, F.col(c)) for c, cond in gates.items() if c in levels.columns})


def assign_boundaries(
    addresses: DataFrame,
    boundaries: DataFrame,
    *,
    vintage_year: int,
    plans: DataFrame | None = None,
    plan_districts: DataFrame | None = None,
    context_date: Column | str | None = None,
    id_col: str = "id",
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """All addresses with their GEOIDs, `assigned`, `plan_id` and `assignment_method`.

    An address outside every state stays unassigned. With `plans` (plan_id,
    state_fips, chamber, effective_from, effective_to) and `plan_districts`
    (plan_id, geoid, district_number, rings) the districts of the plan active on
    `context_date` win over the Census districts; the method says so when the
    congressional plan had a district there, and `plan_id` names the
    congressional plan even when it had none.
    """
    shapes = boundaries.filter(F.col("vintage_year") == vintage_year)
    points = addresses.select(id_col, x, y)
    found = gated(level_geoids(points, shapes, id_col=id_col, x=x, y=y)).filter("state_geoid IS NOT NULL")
    method = F.lit("SPATIAL_JOIN")
    plan_id = F.lit(None).cast("string")
    if plans is not None:
        date = F.lit(context_date) if isinstance(context_date, str) else context_date
        dated = addresses.select(id_col, x, y, F.to_date(date).alias("_date")).join(
            found.select(id_col, F.substring("state_geoid", 1, 2).alias("state_fips")), id_col
        )
        windows = plan_windows(plans.select("plan_id", "state_fips", "chamber", "effective_from", "effective_to"), ["state_fips", "chamber"])
        # One row per address and chamber that has an active plan.
        active = plan_on_date(dated, windows, "_date", ["state_fips"], ["plan_id", "chamber"]).filter("plan_id IS NOT NULL")
        district = F.coalesce(F.nullif("geoid", F.lit("")), "district_number")
        districts = plan_districts.select("plan_id", district.alias("_district"), "rings")
        hits = point_in_polygon(
            active.select(id_col, x, y, "plan_id", "chamber"), districts, x=x, y=y, on=("plan_id",), id_col=id_col, least=_known_first("_district")
        )
        per_plan = active.select(id_col, "plan_id", "chamber", F.lit(None).cast("string").alias("_district")).unionByName(
            hits.select(id_col, "plan_id", "chamber", "_district")
        )
        chosen = per_plan.groupBy(id_col).agg(
            F.min(F.when(F.col("chamber") == "congress", F.col("plan_id"))).alias("_plan"),
            *[F.min(F.when(F.col("chamber") == c, F.col("_district"))).alias(f"_{level}") for c, level in CHAMBER_LEVELS.items()],
        )
        found = found.join(chosen, id_col, "left")
        method = F.when(F.col("_cd").isNotNull(), "PLAN_SPATIAL_JOIN").otherwise(method)
        plan_id = F.col("_plan")
        found = found.withColumns({"assignment_method": method, "plan_id": plan_id})
        for level in CHAMBER_LEVELS.values():
            found = found.withColumn(LEVEL_COLUMNS[level], F.coalesce(F.col(f"_{level}"), F.col(LEVEL_COLUMNS[level])))
    else:
        found = found.withColumns({"assignment_method": method, "plan_id": plan_id})
    columns = [*LEVEL_COLUMNS.values(), "assignment_method", "plan_id"]
    base = addresses.drop(*columns, "census_year", "census_units_assigned_at")
    out = base.join(found.select(id_col, *columns), id_col, "left")
    assigned = F.col("state_geoid").isNotNull()
    return out.withColumns(
        {
            "assigned": assigned,
            "census_year": F.when(assigned, F.lit(vintage_year)),
            "census_units_assigned_at": F.when(assigned, F.current_timestamp()),
        }
    )


def boundary_periods(assigned: DataFrame, vintage: int, context_date: str | None = None, id_col: str = "id") -> DataFrame:
    """Rows for the boundary period table, key `(address_id, vintage, redistricting_plan)`."""
    return assigned.filter("assigned").select(
        F.col(id_col).alias("address_id"),
        F.lit(vintage).alias("vintage"),
        F.col("plan_id").alias("redistricting_plan"),
        F.lit(context_date).cast("date").alias("context_date"),
        *LEVEL_COLUMNS.values(),
        "assignment_method",
    )


def run_summary(assigned: DataFrame) -> DataFrame:
    return assigned.agg(
        F.count("*").alias("processed"),
        F.count_if("assigned").alias("assigned"),
        F.count_if(~F.col("assigned")).alias("failed"),
    )


def boundary_keys(addresses: DataFrame, boundaries: DataFrame, *, id_col: str = "id", key: str = "boundary_key") -> DataFrame:
    """Adds `<level>_key` for each GEOID column, looked up by level, geoid and vintage.

    The GEOIDs go into long form, meet the boundaries once and come back as columns.
    """
    levels = {k: c for k, c in LEVEL_COLUMNS.items() if c in addresses.columns}
    pairs = F.array(*[F.struct(F.lit(k).alias("summary_level"), F.col(c).alias("geoid")) for k, c in levels.items()])
    long = addresses.select(id_col, F.col("census_year").alias("vintage_year"), F.explode(pairs).alias("_p"))
    long = long.select(id_col, "vintage_year", "_p.*").filter("geoid IS NOT NULL")
    found = long.join(boundaries.select("summary_level", "geoid", "vintage_year", key), ["summary_level", "geoid", "vintage_year"])
    wide = found.groupBy(id_col).agg(
        *[F.min(F.when(F.col("summary_level") == k, F.col(key))).alias(f"{k}_key") for k in levels]
    )
    return addresses.join(wide, id_col, "left")


def political_context(addresses: DataFrame, context: DataFrame, on: list[str]) -> DataFrame:
    """Office holders and seats of a boundary, at most one row each, joined to its addresses."""
    return addresses.join(context, on, "left")

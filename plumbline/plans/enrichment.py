"""Addresses with names, demographics, urbanicity and assignments of another vintage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import measures as m
from plumbline.operators.history import best_by_weight
from plumbline.operators.pip import point_in_polygon, shape_columns

# Variable codes and the address fields they fill.
KEY_VARIABLES = {
    "B01001_001E": "total_population",
    "B19013_001E": "median_household_income",
    "B17001_002E": "population_in_poverty",
}


def add_boundary_names(
    addresses: DataFrame,
    boundaries: DataFrame,
    vintage_year: int,
    *,
    id_col: str = "id",
    x: str = "longitude",
    y: str = "latitude",
    levels: tuple[str, ...] = ("state", "county", "cd"),
    first_only: bool = False,
) -> DataFrame:
    """Left join with the boundaries that contain each address: `<level>_geoid, <level>_name`.

    An address in several boundaries of a level gives a row for each, unless `first_only`
    keeps the smallest geoid. All levels come from one spatial join.
    """
    shapes = boundaries.filter((F.col("vintage_year") == vintage_year) & F.col("summary_level").isin(list(levels)))
    points = addresses.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    pair = F.struct("geoid", "name")
    hits = point_in_polygon(
        points.select(id_col, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")),
        shapes.select("geoid", "name", "summary_level", *shape_columns(shapes)),
        id_col=id_col,
        least=pair if first_only else None,
        least_by=("summary_level",),
    )
    out = addresses.drop(*[f"{lv}_{c}" for lv in levels for c in ("geoid", "name")])
    if first_only:
        wide = hits.groupBy(id_col).agg(
            *[F.min(F.when(F.col("summary_level") == lv, pair)).alias(f"_{lv}") for lv in levels]
        )
        names = [F.col(f"_{lv}.{c}").alias(f"{lv}_{c}") for lv in levels for c in ("geoid", "name")]
        return out.join(wide, id_col, "left").select(*out.columns, *names)
    for lv in levels:
        side = hits.filter(F.col("summary_level") == lv).select(
            id_col, F.col("geoid").alias(f"{lv}_geoid"), F.col("name").alias(f"{lv}_name")
        )
        out = out.join(side, id_col, "left")
    return out


def add_demographics(
    addresses: DataFrame,
    facts: DataFrame,
    vintage_year: int,
    *,
    state_fips: str | None = None,
    variables: dict[str, str] | None = None,
) -> DataFrame:
    """Addresses of a vintage with their tract's values and `enriched`.

    `facts` has geoid, vintage_year, variable_code, estimate and optionally
    survey_year, of which the newest wins.
    """
    variables = variables or KEY_VARIABLES
    rows = facts.filter((F.col("vintage_year") == vintage_year) & F.col("variable_code").isin(list(variables)))
    order = F.col("survey_year") if "survey_year" in facts.columns else F.lit(0)
    wide = rows.groupBy(F.col("geoid").alias("tract_geoid")).agg(
        *[
            F.max_by("estimate", F.when(F.col("variable_code") == code, order)).alias(name)
            if "survey_year" in facts.columns
            else F.max(F.when(F.col("variable_code") == code, F.col("estimate"))).alias(name)
            for code, name in variables.items()
        ],
        F.lit(True).alias("_hit"),
    )
    queue = _assigned(addresses, vintage_year, state_fips).drop(*variables.values())
    return queue.join(wide, "tract_geoid", "left").withColumn("enriched", F.coalesce("_hit", F.lit(False))).drop("_hit")


def add_urbanicity(
    addresses: DataFrame, tracts: DataFrame, vintage_year: int, *, state_fips: str | None = None
) -> DataFrame:
    """Addresses of a vintage with `locale_code, locale_category` of their tract and `classified`.

    `tracts` has geoid, vintage_year, urbanicity_code.
    """
    codes = tracts.filter((F.col("vintage_year") == vintage_year) & F.col("urbanicity_code").isNotNull()).select(
        F.col("geoid").alias("tract_geoid"), F.col("urbanicity_code").cast("int").alias("locale_code")
    )
    queue = _assigned(addresses, vintage_year, state_fips).drop("locale_code", "locale_category")
    return queue.join(codes, "tract_geoid", "left").withColumns(
        {"locale_category": m.locale_category("locale_code"), "classified": F.col("locale_code").isNotNull()}
    )


def _assigned(addresses: DataFrame, vintage_year: int, state_fips: str | None) -> DataFrame:
    out = addresses.filter((F.col("census_year") == vintage_year) & F.col("tract_geoid").isNotNull())
    return out.filter(F.col("state_geoid") == state_fips) if state_fips else out


def enrichment_counts(enriched: DataFrame, flag: str = "enriched") -> DataFrame:
    return enriched.agg(F.count("*").alias("total"), F.count_if(flag).alias(flag))


def apply_crosswalk(
    periods: DataFrame, crosswalk: DataFrame, vintages: DataFrame, source_year: int, target_year: int
) -> DataFrame:
    """New boundary periods of the target vintage for addresses that have only the source one.

    Each source tract goes to its heaviest target, equal weights to the smallest
    geoid. Without both vintages configured the result is empty.
    """
    configured = vintages.filter(F.col("decade").isin(source_year, target_year)).select("decade").distinct()
    both = configured.groupBy().count().filter("count = 2").select(F.lit(source_year).alias("vintage"))
    maps = crosswalk.filter(
        (F.col("source_vintage_year") == source_year) & (F.col("target_vintage_year") == target_year)
    ).select("source_geoid", "target_geoid", "weight")
    best = best_by_weight(maps, "source_geoid", "target_geoid", "weight")
    have = periods.filter(F.col("vintage") == target_year).select("address_id")
    todo = (
        periods.filter((F.col("vintage") == source_year) & F.col("tract_geoid").isNotNull())
        .join(both, "vintage", "left_semi")
        .join(have, "address_id", "left_anti")
    )
    moved = todo.join(best, F.col("tract_geoid") == F.col("source_geoid"))
    return moved.select(
        "address_id",
        F.lit(target_year).alias("vintage"),
        F.lit(None).cast("string").alias("redistricting_plan"),
        "state_geoid",
        F.when(F.length("target_geoid") >= 5, F.substring("target_geoid", 1, 5)).otherwise(F.col("county_geoid")).alias("county_geoid"),
        F.col("target_geoid").alias("tract_geoid"),
        F.lit("FIPS_LOOKUP").alias("assignment_method"),
        F.col("weight"),
    )


def gold_addresses(silver: DataFrame, boundaries: DataFrame, facts: DataFrame, tracts: DataFrame, vintage_year: int) -> DataFrame:
    """Silver addresses with state, county and district names, demographics and locale."""
    named = add_boundary_names(
        silver.filter(F.col("census_year") == vintage_year), boundaries, vintage_year, first_only=True
    )
    variables = {"B01001_001E": "total_population", "B19013_001E": "median_household_income", "B01002_001E": "median_age"}
    tract_values = add_demographics(named, facts, vintage_year, variables=variables).select("id", *variables.values())
    locale = add_urbanicity(named, tracts, vintage_year).select("id", "locale_code", "locale_category")
    return named.join(tract_values, "id", "left").join(locale, "id", "left")

"""What is new in a catalog: Census vintages and district plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts that mark a boundary plan in a catalog.
PLAN_TYPES = ("congress", "state_senate", "state_house")


def acs_vintages(catalog: DataFrame, title: str = "title", vintage: str = "c_vintage") -> DataFrame:
    """Distinct numeric vintages of the 5-year survey in a dataset catalog."""
    five_year = F.col(title).contains("American Community Survey: 5-Year") | F.col(title).contains("ACS 5-Year")
    text = F.col(vintage).cast("string")
    return (
        catalog.filter(five_year & text.rlike(r"^\d+$")).select(text.cast("int").alias("vintage")).distinct()
    )


def tiger_vintages(listing: DataFrame, entry: str = "entry") -> DataFrame:
    """Years of the `TIGERyyyy` folders in a directory listing."""
    year = F.regexp_extract(F.substring_index(F.col(entry), "/", -1), r"^TIGER(\d{4})", 1)
    return listing.select(year.alias("y")).filter("y != ''").select(F.col("y").cast("int").alias("vintage"))


def new_vintage(available: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: `latest` available, `last_loaded`, and whether there is something new."""
    both = available.select(F.col("vintage").alias("a"), F.lit(None).cast("int").alias("b")).union(
        loaded.select(F.lit(None).cast("int"), "vintage")
    )
    newer = F.col("latest").isNotNull() & (F.col("last_loaded").isNull() | (F.col("latest") > F.col("last_loaded")))
    return both.agg(F.max("a").alias("latest"), F.max("b").alias("last_loaded")).withColumn("has_update", newer)


def boundary_plans(catalog: DataFrame, states: list[str] | None = None, plan_types: list[str] | None = None) -> DataFrame:
    """Catalog entries whose name or type mentions a plan type, in the given states."""
    wanted = F.lit(False)
    for kind in plan_types or PLAN_TYPES:
        wanted = wanted | F.lower("name").contains(kind) | F.coalesce(F.col("type").contains(kind), F.lit(False))
    out = catalog.filter(wanted)
    return out.filter(F.col("state").isin(states)) if states is not None else out


def new_plans(plans: DataFrame, known: DataFrame, id_col: str = "id") -> DataFrame:
    return plans.join(known.select(id_col), id_col, "left_anti")

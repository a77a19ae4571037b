"""Matching addresses with geocoder results that were landed as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import text as t
from plumbline.operators.history import latest_per_key


def geocode_queue(addresses: DataFrame, state: str | None = None, force: bool = False, limit: int = 0) -> DataFrame:
    out = addresses if force else addresses.filter("NOT geocoded")
    if state:
        out = out.filter(F.col("state_abbreviation") == state.upper())
    return out.limit(limit) if limit else out


def batch_input(addresses: DataFrame) -> DataFrame:
    """What a batch geocoder takes: id, street, city, state, zip and the one-line form."""
    parts = ("primary_number", "street_name", "street_suffix")
    return addresses.select(
        F.col("id").cast("string").alias("id"),
        t.street_line(*parts).alias("street"),
        *[F.coalesce(c, F.lit("")).alias(n) for c, n in (("city_name", "city"), ("state_abbreviation", "state"), ("zip5", "zipcode"))],
        t.one_line_address(*parts, "city_name", "state_abbreviation", "zip5").alias("one_line"),
    )


def _one_per_id(results: DataFrame) -> DataFrame:
    order = ["result_order"] if "result_order" in results.columns else [c for c in results.columns if c != "id"]
    return latest_per_key(results, ["id"], order).drop("result_order")


def match_geocodes(
    addresses: DataFrame, census: DataFrame | None = None, fallback: DataFrame | None = None, mode: str = "dual"
) -> DataFrame:
    """Addresses with position, `geocoded, geocoded_at, geocode_source, geocode_quality` and GEOIDs.

    `census` has (id, matched, lat, lon, match_type, state_fips, county_fips,
    tract, block); `fallback` has (id, lat, lon) and serves what the first source
    missed. Of repeated results for an id, the greatest by a `result_order` column
    counts, or by all columns where a source has none. `mode` is dual, census-only or fallback-only. `has_position` needs
    both coordinates to differ from zero for the first source.
    """
    if mode not in ("dual", "census-only", "fallback-only"):
        raise ValueError(f"unknown mode {mode!r}")
    new = ["latitude", "longitude", "geocoded", "geocoded_at", "geocode_source", "geocode_quality", "has_position"]
    geoids = ["state_geoid", "county_geoid", "tract_geoid", "block_group_geoid", "block_geoid"]
    out = addresses.drop(*new, *geoids)
    null = F.lit(None)
    if mode != "fallback-only":
        out = out.join(_one_per_id(census.filter("matched")).select("id", F.struct("*").alias("_a")), "id", "left")
    else:
        out = out.withColumn("_a", F.expr(f"CAST(NULL AS {_CENSUS})"))
    if mode != "census-only":
        found = fallback.filter("lat IS NOT NULL AND lon IS NOT NULL")
        out = out.join(_one_per_id(found).select("id", F.struct("lat", "lon").alias("_b")), "id", "left")
    else:
        out = out.withColumn("_b", F.expr("CAST(NULL AS STRUCT<lat: DOUBLE, lon: DOUBLE>)"))
    first = F.col("_a.lat").isNotNull() | F.col("_a.match_type").isNotNull() | F.col("_a.id").isNotNull()
    second = ~first & F.col("_b.lat").isNotNull() & F.col("_b.lon").isNotNull()
    fips = t.geoids_from_fips(*[F.col(f"_a.{c}") for c in ("state_fips", "county_fips", "tract", "block")])
    return out.select(
        "*",
        F.when(first, F.col("_a.lat")).when(second, F.col("_b.lat")).alias("latitude"),
        F.when(first, F.col("_a.lon")).when(second, F.col("_b.lon")).alias("longitude"),
        (first | second).alias("geocoded"),
        F.when(first | second, F.current_timestamp()).alias("geocoded_at"),
        F.when(first, F.lit("census")).when(second, F.lit("nominatim")).otherwise(null).alias("geocode_source"),
        F.when(first, F.col("_a.match_type")).when(second, F.lit("Approximate")).otherwise(null).alias("geocode_quality"),
        (second | (first & F.coalesce((F.col("_a.lat") != 0) & (F.col("_a.lon") != 0), F.lit(False)))).alias("has_position"),
        *[F.when(first, fips[g]).alias(g) for g in geoids],
    ).drop("_a", "_b")


_CENSUS = (
    "STRUCT<id: BIGINT, matched: BOOLEAN, lat: DOUBLE, lon: DOUBLE, match_type: STRING, "
    "state_fips: STRING, county_fips: STRING, tract: STRING, block: STRING>"
)


def match_summary(matched: DataFrame) -> DataFrame:
    source = F.col("geocode_source")
    return matched.agg(
        F.count("*").alias("processed"),
        F.count_if(source == "census").alias("census_matched"),
        F.count_if(source == "nominatim").alias("fallback_matched"),
        F.count_if(~F.col("geocoded")).alias("failed"),
    )

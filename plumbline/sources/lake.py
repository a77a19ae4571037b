"""Lake tables: schemas, registry, creation, reads and safe replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the lake tables.
SCHEMAS = {
    "bronze.addresses": (
        "id BIGINT NOT NULL, primary_number STRING, street_name STRING, street_suffix STRING, city_name STRING, "
        "state_abbreviation STRING, zip5 STRING, latitude DECIMAL(22,16), longitude DECIMAL(22,16), "
        "source_file STRING, source_row INT, ingested_at TIMESTAMP NOT NULL"
    ),
    "bronze.boundaries": (
        "geoid STRING NOT NULL, name STRING, summary_level STRING NOT NULL, vintage_year INT NOT NULL, "
        "state_fips STRING, area_land BIGINT, area_water BIGINT, wkt STRING, ingested_at TIMESTAMP NOT NULL"
    ),
    "silver.addresses": (
        "id BIGINT NOT NULL, primary_number STRING, street_name STRING, street_suffix STRING, city_name STRING, "
        "state_abbreviation STRING, zip5 STRING, latitude DOUBLE, longitude DOUBLE, geocoded BOOLEAN NOT NULL, "
        "geocode_source STRING, geocode_quality STRING, geocoded_at TIMESTAMP, census_year INT NOT NULL, "
        "state_geoid STRING, county_geoid STRING, tract_geoid STRING, block_group_geoid STRING, block_geoid STRING, "
        "vtd_geoid STRING, cd_geoid STRING, sldl_geoid STRING, sldu_geoid STRING, census_units_assigned_at TIMESTAMP"
    ),
    "silver.demographics": (
        "geoid STRING NOT NULL, vintage_year INT NOT NULL, summary_level STRING NOT NULL, "
        "variable_code STRING NOT NULL, survey_type STRING NOT NULL, estimate DOUBLE, margin_of_error DOUBLE"
    ),
    "gold.enriched_addresses": (
        "id BIGINT NOT NULL, state_abbreviation STRING, city_name STRING, zip5 STRING, latitude DOUBLE, "
        "longitude DOUBLE, census_year INT NOT NULL, state_geoid STRING, state_name STRING, county_geoid STRING, "
        "county_name STRING, tract_geoid STRING, cd_geoid STRING, cd_name STRING, vtd_geoid STRING, "
        "sldl_geoid STRING, sldu_geoid STRING, total_population BIGINT, median_household_income DOUBLE, "
        "median_age DOUBLE, locale_code INT, locale_category STRING"
    ),
}
SCHEMAS["silver.boundaries"] = SCHEMAS["bronze.boundaries"]

# Partition columns of the lake tables.
PARTITIONS = {
    "bronze.addresses": ["state_abbreviation"],
    "bronze.boundaries": ["summary_level", "vintage_year"],
    "silver.addresses": ["state_abbreviation", "census_year"],
    "silver.boundaries": ["summary_level", "vintage_year"],
    "silver.demographics": ["summary_level", "vintage_year"],
    "gold.enriched_addresses": ["state_abbreviation", "census_year"],
}


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[table])


def table_path(root: str, table: str) -> str:
    """Folder of a registered table, or `table` itself when it is already a path."""
    return f"{root.rstrip('/')}/{table.replace('.', '/')}" if table in SCHEMAS else table


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write next to `path`, then swap; a failed write leaves the old table as it was."""
    spark = df.sparkSession
    path = path.rstrip("/")
    staging, old = f"{path}_staging_{uuid.uuid4().hex}", f"{path}_old_{uuid.uuid4().hex}"
    fs, target = _hadoop(spark, path)
    new_path = spark._jvm.org.apache.hadoop.fs.Path(staging)
    old_path = spark._jvm.org.apache.hadoop.fs.Path(old)
    writer = df.write
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staging)
    except Exception:
        fs.delete(new_path, True)
        raise
    had_old = fs.exists(target)
    if had_old and not fs.rename(target, old_path):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new_path, target):
        if had_old:
            fs.rename(old_path, target)
        raise OSError(f"cannot move {staging} to {path}")
    if had_old:
        fs.delete(old_path, True)


def create_table(spark: SparkSession, root: str, table: str, overwrite: bool = False) -> str:
    """An empty registered table; an existing one is kept unless `overwrite`."""
    if table not in SCHEMAS:
        raise ValueError(f"unknown table {table!r}; known: {sorted(SCHEMAS)}")
    path = table_path(root, table)
    if overwrite or not exists(spark, path):
        # The partition columns stay in the empty file: without rows there is no folder to name them.
        replace_table(spark.createDataFrame([], table_schema(table)), path)
    return path


def create_all_tables(spark: SparkSession, root: str, overwrite: bool = False) -> dict[str, str]:
    return {table: create_table(spark, root, table, overwrite) for table in SCHEMAS}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns of a registered table in order, cast to its types; further columns follow."""
    fields = table_schema(table).fields
    known = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ]
    extra = [c for c in df.columns if c not in {f.name for f in fields}]
    return df.select(*known, *extra)


def write_table(df: DataFrame, root: str, table: str) -> str:
    """Replace a registered table with `df`, partitioned as registered."""
    path = table_path(root, table)
    replace_table(conform(df, table), path, PARTITIONS[table])
    return path


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A registered table with its declared types, or any parquet folder."""
    if table not in SCHEMAS:
        return spark.read.option("mergeSchema", "true").parquet(table)
    path = table_path(root, table)
    declared = table_schema(table)
    # Columns written later than the declaration follow; declared types keep codes like '01' whole.
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    extra = [f for f in found if f.name not in declared.names]
    return spark.read.schema(T.StructType([*declared, *extra])).parquet(path).select(*declared.names, *[f.name for f in extra])


def address_queue(addresses: DataFrame, boundaries: DataFrame, vintage_year: int) -> tuple[DataFrame, DataFrame]:
    """Addresses with coordinates and boundaries of one vintage that have a shape."""
    points = addresses.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    shapes = boundaries.filter((F.col("vintage_year") == vintage_year) & F.col("wkt").isNotNull())
    return points, shapes

"""Boundary tables by type, state and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.operators.grid import cell_index
from plumbline.sources.lake import replace_table

PARTITIONS = ["boundary_type", "state_fips"]


def with_rings(boundaries: DataFrame, wkt: str = "wkt") -> DataFrame:
    """The boundaries with their shape as `rings` in place of the text."""
    return boundaries.withColumn("rings", F.expr(g.rings_from_wkt(wkt))).drop(wkt)


def write_boundaries(boundaries: DataFrame, path: str) -> None:
    replace_table(boundaries, path, PARTITIONS)


def select_boundaries(
    boundaries: DataFrame,
    state_fips: str | list[str] | None = None,
    boundary_types: list[str] | None = None,
    year: int | None = None,
) -> DataFrame:
    """Boundaries of the given states, types and year; partition filters where those are the columns."""
    out = boundaries
    if state_fips:
        states = [state_fips] if isinstance(state_fips, str) else state_fips
        out = out.filter(F.col("state_fips").isin([s.zfill(2) for s in states]))
    if boundary_types:
        out = out.filter(F.col("boundary_type").isin(boundary_types))
    if year:
        out = out.filter(F.col("vintage_year") == year)
    return out


def read_boundaries(spark: SparkSession, path: str, **selection) -> DataFrame:
    df = spark.read.parquet(path)
    # Partition values come back as numbers when they look like numbers.
    df = df.withColumn("state_fips", F.lpad(F.col("state_fips").cast("string"), 2, "0"))
    return select_boundaries(df, **selection)


def write_cell_index(boundaries: DataFrame, path: str, partition_by: tuple[str, ...] = ("summary_level", "vintage_year")) -> None:
    """Store the grid index of boundaries with `rings`, built once per vintage.

    Every job that takes boundaries with `rings` takes the stored index in their place.
    """
    replace_table(cell_index(boundaries), path, list(partition_by))


def read_cell_index(spark: SparkSession, path: str, vintage_year: int | None = None, levels: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if vintage_year:
        df = df.filter(F.col("vintage_year") == vintage_year)
    return df.filter(F.col("summary_level").isin(levels)) if levels else df

"""Voter files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.lake import replace_table

# Default column names of a voter file.
DEFAULT_COLUMNS = {
    "longitude": "vb_tsmart_longitude",
    "latitude": "vb_tsmart_latitude",
    "precinct": "vb_vf_national_precinct_code",
    "county": "vb_tsmart_county_name",
    "cd": "vb_vf_cd",
    "sd": "vb_vf_sd",
    "hd": "vb_vf_hd",
}
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: str) -> Column:
    """Double from a text, null when it is not a plain decimal number."""
    text = F.col(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def _require(df: DataFrame, *columns: str) -> None:
    missing = set(columns) - set(df.columns)
    if missing:
        raise ValueError(f"coordinate columns {sorted(missing)} not found; the file has {df.columns}")


def coerce_points(df: DataFrame, longitude: str, latitude: str, x: str = "x", y: str = "y") -> DataFrame:
    """Adds numeric `x, y`; rows whose coordinates are unreadable or out of range are left out."""
    _require(df, longitude, latitude)
    out = df.withColumns({x: to_number(longitude), y: to_number(latitude)})
    return out.filter(F.col(x).between(-180, 180) & F.col(y).between(-90, 90))


def coordinate_report(df: DataFrame, longitude: str, latitude: str) -> DataFrame:
    """One row: how many rows are kept, unreadable, or out of range."""
    _require(df, longitude, latitude)
    lon, lat = to_number(longitude), to_number(latitude)
    readable = lon.isNotNull() & lat.isNotNull()
    kept = readable & lon.between(-180, 180) & lat.between(-90, 90)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(kept).alias("kept"),
        F.count_if(~readable).alias("unreadable"),
        F.count_if(readable & ~kept).alias("out_of_range"),
    )


def read_delimited(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A file with a header line, every column as text so that codes keep their zeros."""
    return spark.read.csv(path, sep=sep, header=True, inferSchema=False)


def read_voters(
    spark: SparkSession,
    path: str,
    longitude: str = DEFAULT_COLUMNS["longitude"],
    latitude: str = DEFAULT_COLUMNS["latitude"],
    sep: str = ",",
) -> DataFrame:
    """Voters with usable coordinates, lazily."""
    return coerce_points(read_delimited(spark, path, sep), longitude, latitude)


def load_voters(spark: SparkSession, path: str, table: str, partition_by: list[str] | None = None, **read) -> int:
    """Replace the table at path `table` with a voter file; returns the rows written."""
    replace_table(read_voters(spark, path, **read), table, partition_by)
    return spark.read.parquet(table).count()

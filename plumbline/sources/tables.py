"""Session tables: unions by name pattern, copies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns and types of the road tables.
ROAD_COLUMNS = {"linearid": "decimal(38,0)", "fullname": "string", "rttyp": "string", "mtfcc": "string", "geom": "string"}


def matching_tables(
    spark: SparkSession, contains: str, year: str | None = None, state: str | None = None, among: list[str] | None = None
) -> list[str]:
    """Names like `tl_YYYY_SS_...` that contain a word, by the year and state in them; highest state first.

    The names come from `among`, or from all tables and views of the session.
    """
    names = [t.name for t in spark.catalog.listTables()] if among is None else among
    names = [n for n in names if contains in n]
    if year:
        names = [n for n in names if n[3:7] == year]
    if state:
        names = [n for n in names if n[8:10] == state]
    return sorted(names, key=lambda n: n[8:10], reverse=True)


def union_tables(spark: SparkSession, names: list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """The tables in one frame: `table_name` and the columns cast to the given types."""
    columns = columns or ROAD_COLUMNS
    if not names:
        raise ValueError("no table matches")
    parts = [
        spark.table(n).select(F.lit(n).alias("table_name"), *[F.col(c).cast(t).alias(c) for c, t in columns.items()])
        for n in names
    ]
    return reduce(DataFrame.unionByName, parts)


def copy_table(df: DataFrame, path: str) -> DataFrame:
    """A stored copy that can be changed without touching the original."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def select_into(df: DataFrame, view: str) -> DataFrame:
    """The result under a name other statements of the session can use."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.table(view)

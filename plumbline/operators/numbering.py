"""Consecutive numbers without sorting everything in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import spool


def number_rows(df: DataFrame, order: list[str], name: str, by: list[str] | None = None, start: int = 1) -> DataFrame:
    """Adds `name`: `start, start + 1, ...` in the given order, per `by` group when given.

    Rows are range-partitioned on the order; each part is numbered on its own
    and shifted by the number of rows in the parts before it, a table with one
    row per part. `by + order` has to be unique for a repeatable result.
    """
    by = by or []
    ranged = df.repartitionByRange(*[F.col(c) for c in [*by, *order]]).withColumn("_slice", F.spark_partition_id())
    ranged = spool(ranged, "ranged")
    per_part = ranged.groupBy("_slice").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = per_part.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_slice").orderBy(*by, *order))
    numbered = ranged.withColumn("_row", local).join(F.broadcast(shift), "_slice")
    numbered = numbered.withColumn("_row", F.col("_row") + F.col("_before")).drop("_slice", "_before")
    if not by:
        return numbered.withColumn(name, F.col("_row") + F.lit(start - 1)).drop("_row")
    first = numbered.groupBy(*by).agg(F.min("_row").alias("_first"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    joined = numbered.alias("a").join(first.alias("b"), same)
    return joined.select(*[F.col(f"a.{c}") for c in df.columns], (F.col("a._row") - F.col("b._first") + start).alias(name))

"""Merging rows into tables by natural key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.history import latest_per_key
from plumbline.session import spool
from plumbline.sources.lake import exists, replace_table

# Partitions named one by one in a filter; beyond that a join selects them.
_MAX_LISTED_PARTITIONS = 500


def _same_keys(keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return cond


def _without(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.alias("a").join(known.select(*keys).alias("b"), _same_keys(keys), "left_anti")


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], latest_by: list[str] | None = None) -> DataFrame:
    """Target rows not in the source plus all source rows; null keys count as equal.

    `latest_by` orders source rows of the same key, the greatest wins; without it
    source keys have to be unique.
    """
    if latest_by:
        source = latest_per_key(source, keys, latest_by)
    return _without(target, source, keys).unionByName(source, allowMissingColumns=True)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows plus the source rows whose key is new."""
    return target.unionByName(_without(source, target, keys), allowMissingColumns=True)


def read_as(spark: SparkSession, path: str, source: DataFrame) -> DataFrame:
    """The table at `path` with the source's types for the columns they share.

    Types found in folder names would turn a code like '01' into a number.
    """
    given = {f.name: f.dataType for f in source.schema}
    fields = [T.StructField(f.name, given.get(f.name, f.dataType)) for f in spark.read.parquet(path).schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def upsert_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition_by: list[str] | None = None,
    latest_by: list[str] | None = None,
) -> DataFrame:
    """Merge `source` into the table at `path` and return the table.

    Source rows of one key are reduced to the greatest by `latest_by`, or by
    their other columns. With `partition_by` columns that are part of the key,
    only the partitions the source touches are read and rewritten; otherwise the
    table is swapped.
    """
    rest = [c for c in source.columns if c not in keys]
    source = latest_per_key(source, keys, latest_by or rest) if rest else source.distinct()
    if not exists(spark, path):
        replace_table(source, path, partition_by)
        return read_as(spark, path, source)
    target = read_as(spark, path, source)
    parts = [c for c in partition_by or [] if c in keys]
    if parts and parts == list(partition_by or []):
        target = _touched_partitions(target, source.select(*parts).distinct(), parts)
        # The merged rows leave the old files before those are overwritten.
        merged = spool(merge_upsert(target, source, keys), "merge")
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    else:
        replace_table(merge_upsert(target, source, keys), path, partition_by)
    return read_as(spark, path, source)


def _touched_partitions(target: DataFrame, touched: DataFrame, parts: list[str]) -> DataFrame:
    """Target rows in the given partitions; a moderate number of them becomes a filter that prunes folders."""
    values = touched.take(_MAX_LISTED_PARTITIONS + 1)
    if len(values) > _MAX_LISTED_PARTITIONS:
        return target.alias("a").join(touched.alias("b"), _same_keys(parts), "left_semi")
    wanted = F.lit(False)
    for row in values:
        same = F.lit(True)
        for p in parts:
            same = same & (F.col(p).isNull() if row[p] is None else F.col(p) == F.lit(row[p]))
        wanted = wanted | same
    return target.filter(wanted)


def update_rows(df: DataFrame, condition, assignments: dict) -> DataFrame:
    """New values for the rows where `condition` holds; a null condition leaves a row alone."""
    condition = F.expr(condition) if isinstance(condition, str) else condition
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in assignments.items()})


def update_from(df: DataFrame, other: DataFrame, key: str, columns: dict[str, object]) -> DataFrame:
    """Columns taken from `other` by key; rows without a match get the given default."""
    found = other.select(key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in columns])
    out = df.drop(*columns).join(found, key, "left")
    new = {c: F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.lit(default)) for c, default in columns.items()}
    return out.withColumns(new).drop("_hit", *[f"_{c}" for c in columns])

"""Redistricting plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLAN_SCHEMA = (
    "state_fips string, chamber string, cycle_year int, plan_name string, plan_type string, source string, "
    "num_districts int, enacted_date date, effective_from date, effective_to date, court_case string, data_source string"
)


def read_plans(spark: SparkSession, path: str) -> DataFrame:
    """Plans from a fixture file: a JSON array of records with their values under `fields`."""
    raw = spark.read.json(path, multiLine=True, schema=f"model string, fields struct<{_json_fields()}>")
    return typed_plans(raw.select("fields.*"))


def _json_fields() -> str:
    names = [part.strip().split(" ") for part in PLAN_SCHEMA.split(",")]
    return ", ".join(f"{n}: {'int' if t == 'int' else 'string'}" for n, t in names)


def typed_plans(plans: DataFrame) -> DataFrame:
    names = [part.strip().split(" ") for part in PLAN_SCHEMA.split(",")]
    return plans.select(*[F.col(n).cast(t).alias(n) for n, t in names])

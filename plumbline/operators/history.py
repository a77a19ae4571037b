"""Latest rows, validity windows and sightings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest `order` of each key.

    An aggregate, so each task sends on one row per key however many a key has.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def best_by_weight(df: DataFrame, key: str, target: str, weight: str) -> DataFrame:
    """`(key, target, weight)` of the heaviest target; equal weights go to the smallest target, null weights come last."""
    best = F.min(F.struct(F.col(weight).isNull().alias("n"), (-F.col(weight)).alias("w"), F.col(target).alias("t")))
    return df.groupBy(key).agg(best.alias("_b")).select(
        key, F.col("_b.t").alias(target), (-F.col("_b.w")).alias(weight)
    )


def validity_windows(df: DataFrame, key: str = "geoid", vintage: str = "vintage_year") -> DataFrame:
    """Adds `effective_from, effective_to, is_current` from the order of the vintages of a key.

    A version ends the day before the next one starts; the last one is current.
    """
    later = F.lead(vintage).over(Window.partitionBy(key).orderBy(vintage))
    first_day = F.make_date(F.col(vintage).cast("int"), F.lit(1), F.lit(1))
    return (
        df.withColumn("_next", later)
        .withColumn("effective_from", first_day)
        .withColumn("effective_to", F.date_sub(F.make_date(F.col("_next").cast("int"), F.lit(1), F.lit(1)), 1))
        .withColumn("is_current", F.col("_next").isNull())
        .drop("_next")
    )


def sighting_range(df: DataFrame, key: str, year: str, seen: str) -> DataFrame:
    """First and last boundary year and first date of each key."""
    return df.groupBy(key).agg(
        F.min(year).alias("tiger_first_seen_year"),
        F.max(year).alias("tiger_last_seen_year"),
        F.min(seen).alias("first_seen_date"),
    )

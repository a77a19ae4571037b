"""Spreading crowded keys over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is crowded above this many rows, or above total / MAX_HOT_KEYS if that is more.
HOT_ROWS = 20_000
MAX_HOT_KEYS = 10_000


def key_spread(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame | None:
    """Crowded keys and the number of parts `_parts` each is to be split into; None without any.

    At most MAX_HOT_KEYS rows come out whatever the size of the data, since
    every one stands for more than `total / MAX_HOT_KEYS` rows; that is what
    makes the result safe to broadcast.
    """
    row = counts.agg(F.sum(n).alias("total"), F.max(n).alias("top")).first()
    return hot_keys(counts, keys, row["total"], row["top"], n)


def hot_keys(counts: DataFrame, keys: list[str], total, top, n: str = "n") -> DataFrame | None:
    """`key_spread` for callers that know the sum and the maximum of the counts."""
    limit = max(HOT_ROWS, (total or 0) // MAX_HOT_KEYS)
    if (top or 0) <= limit:
        return None
    return counts.filter(F.col(n) > limit).select(*keys, F.ceil(F.col(n) / limit).cast("int").alias("_parts"))


def spread_rows(df: DataFrame, hot: DataFrame | None, keys: list[str], by: str) -> DataFrame:
    """Adds `_salt`: which part of its key a row belongs to (0 for ordinary keys)."""
    if hot is None:
        return df.withColumn("_salt", F.lit(0))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    return (
        df.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(by), parts).cast("int"))
        .drop("_parts")
    )


def repeat_rows(df: DataFrame, hot: DataFrame | None, keys: list[str]) -> DataFrame:
    """Repeats each row once per part of its key, the other side of `spread_rows`."""
    if hot is None:
        return df.withColumn("_salt", F.lit(0))
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    return (
        df.join(F.broadcast(hot), keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), last)))
        .drop("_parts")
    )

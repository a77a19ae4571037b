"""Wide and long forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The population titles of the citizen voting age tables.
CVAP_TITLES = [
    "Total",
    "Not Hispanic or Latino",
    "American Indian or Alaska Native Alone",
    "Asian Alone",
    "Black or African American Alone",
    "Native Hawaiian or Other Pacific Islander Alone",
    "White Alone",
    "American Indian or Alaska Native and White",
    "Asian and White",
    "Black or African American and White",
    "American Indian or Alaska Native and Black or African American",
    "Remainder of Two or More Race Responses",
    "Hispanic or Latino",
]


def pivot_sum(df: DataFrame, keys: list[str], title: str, value: str, titles: list) -> DataFrame:
    """Sum of `value` per key with one column per listed title; other titles vanish."""
    return df.groupBy(*keys).pivot(title, titles).agg(F.sum(value))


def cvap_table(block_groups: DataFrame, titles: list[str] | None = None) -> DataFrame:
    """Citizen voting age (`cvap`) and citizen (`cit`) estimates by title, one row per block group.

    Both sums of a title come from one pivot.
    """
    titles = titles or CVAP_TITLES
    sums = (F.sum("cvap_est").alias("cvap"), F.sum("cit_est").alias("cit"))
    wide = block_groups.groupBy("geoname", "geoid").pivot("lntitle", titles).agg(*sums)
    return wide.select("geoname", "geoid", *[F.col(f"`{t}_{kind}`").alias(f"{kind}_{t}") for kind in ("cvap", "cit") for t in titles])


def to_long(df: DataFrame, ids: list[str], codes: list[str]) -> DataFrame:
    """`(ids..., variable_code, value, moe_value)` with one row per id and estimate code.

    The margin of error comes from the code's `M` column when the input has it.
    An input without any of the codes gives no rows.
    """
    have = set(df.columns)
    cells = []
    for code in codes:
        if code not in have:
            continue
        moe = f"{code[:-1]}M"
        margin = F.col(moe).cast("string") if code.endswith("E") and moe in have else F.lit(None).cast("string")
        cells.append(
            F.struct(
                F.lit(code).alias("variable_code"),
                F.col(code).cast("string").alias("value"),
                margin.alias("moe_value"),
            )
        )
    if not cells:
        none = F.lit(None).cast("string")
        return df.select(*ids, *[none.alias(c) for c in ("variable_code", "value", "moe_value")]).filter(F.lit(False))
    return df.select(*ids, F.explode(F.array(*cells)).alias("_c")).select(*ids, "_c.*")

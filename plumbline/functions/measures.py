"""Survey reliability, overlap classes, locale codes, cluster labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts the Census API uses for a missing cell.
NULL_MARKERS = ("-", "null", "**")

# NCES locale categories and subcategories by digit.
LOCALE_CATEGORIES = {1: "city", 2: "suburban", 3: "town", 4: "rural"}
LOCALE_SUBCATEGORIES = {
    1: ("large", "midsize", "small"),
    2: ("large", "midsize", "small"),
    3: ("fringe", "distant", "remote"),
    4: ("fringe", "distant", "remote"),
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_number(c, to: str = "double") -> Column:
    """Number from a Census cell; null for a missing marker or unreadable text."""
    text = F.trim(_col(c).cast("string"))
    value = F.when(~text.isin(*NULL_MARKERS), text).try_cast(to)
    return F.when(~F.isnan(value), value) if to == "double" else value


def coefficient_of_variation(estimate, moe) -> Column:
    """Percent; the published margin is at 90 percent confidence (factor 1.645)."""
    return F.abs(_col(moe)) / F.lit(1.645) / F.nullif(F.abs(_col(estimate)), F.lit(0.0)) * 100


def reliability(cv) -> Column:
    cv = F.abs(_col(cv))
    return (
        F.when(cv.isNull(), "suppressed").when(cv < 12, "high").when(cv < 40, "medium").otherwise("low")
    )


def percent_of(part, whole) -> Column:
    return F.coalesce(_col(part) / F.nullif(_col(whole), F.lit(0.0)) * 100, F.lit(0.0))


def county_cd_relationship(pct_county, pct_cd) -> Column:
    """Containment at 99.9 percent, the county side first."""
    return (
        F.when(_col(pct_county) >= 99.9, "COUNTY_IN_CD")
        .when(_col(pct_cd) >= 99.9, "CD_IN_COUNTY")
        .otherwise("SPLIT")
    )


def is_dominant(pct_source) -> Column:
    return _col(pct_source) > 50.0


def locale_category(code) -> Column:
    out = F.lit(None).cast("string")
    for digit, name in LOCALE_CATEGORIES.items():
        out = F.when(F.floor(_col(code) / 10) == digit, name).otherwise(out)
    return out


def locale_subcategory(code) -> Column:
    out = F.lit(None).cast("string")
    for digit, names in LOCALE_SUBCATEGORIES.items():
        for unit, name in enumerate(names, 1):
            out = F.when(_col(code) == digit * 10 + unit, name).otherwise(out)
    return out


def cluster_label(cluster, *prefix) -> Column:
    """`prefix-...-cluster`, or '-1' for noise."""
    c = _col(cluster)
    text = F.concat_ws("-", *[_col(p).cast("string") for p in prefix], c.cast("string"))
    return F.when(c.isNull() | (c < 0), F.lit("-1")).otherwise(text)

"""Calendar attributes, election and Census days, plan cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_election_day(d) -> Column:
    """First Tuesday after the first Monday of November."""
    d = _col(d)
    return (F.month(d) == 11) & (F.weekday(d) == 1) & F.dayofmonth(d).between(2, 8)


def is_census_day(d) -> Column:
    d = _col(d)
    return (F.month(d) == 4) & (F.dayofmonth(d) == 1) & (F.year(d) % 10 == 0)


def federal_fiscal_year(d) -> Column:
    """October to September, named after the year it ends in."""
    d = _col(d)
    return F.year(d) + (F.month(d) >= 10).cast("int")


def calendar_attributes(days: DataFrame, day: str = "calendar_date") -> DataFrame:
    """One row per input day with every calendar column of the time dimension."""
    d = F.col(day)
    election = is_election_day(d)
    return days.select(
        d.alias("calendar_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekday(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        election.alias("is_election_day"),
        (election & (F.year(d) % 4 == 0)).alias("is_presidential_election"),
        (election & (F.year(d) % 4 == 2)).alias("is_midterm_election"),
        is_census_day(d).alias("is_census_day"),
        federal_fiscal_year(d).alias("fiscal_year"),
        federal_fiscal_year(d).alias("federal_fiscal_year"),
    )


def time_dimension(spark: SparkSession, start_year: int = 2000, end_year: int = 2030) -> DataFrame:
    days = spark.range(start_year, end_year + 1).select(
        F.explode(
            F.expr("sequence(make_date(CAST(id AS INT), 1, 1), make_date(CAST(id AS INT), 12, 31))")
        ).alias("calendar_date")
    )
    return calendar_attributes(days)


def redistricting_cycles(plans: DataFrame) -> DataFrame:
    """One row per cycle year found in the plans."""
    y = F.col("cycle_year").cast("int")
    return plans.select(y.alias("cycle_year")).distinct().select(
        "cycle_year",
        y.alias("decennial_census_year"),
        y.alias("census_year"),
        (y + 2).alias("first_election_year"),
        F.make_date(y + 2, F.lit(1), F.lit(1)).alias("effective_start"),
        F.make_date(y + 12, F.lit(1), F.lit(1)).alias("effective_end"),
    )


def iso_date(c) -> Column:
    """Date from an ISO text, null when it is not one."""
    return F.expr(f"try_to_date({c}, 'yyyy-MM-dd')") if isinstance(c, str) else F.try_to_date(c, "yyyy-MM-dd")

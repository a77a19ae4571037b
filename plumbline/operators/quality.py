"""Key, range and reference checks that return the offending rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Range and choice rules of the warehouse tables, as conditions that must hold.
RULES = {
    "dim_geography": {"vintage_year": "vintage_year BETWEEN 1790 AND 2100"},
    "dim_time": {"quarter": "quarter BETWEEN 1 AND 4", "month": "month BETWEEN 1 AND 12"},
    "dim_survey": {"survey_type": "survey_type IN ('acs5', 'acs1', 'decennial', 'decennial_pl')"},
    "dim_census_variable": {"variable_type": "variable_type IN ('extensive', 'intensive')"},
    "dim_redistricting_cycle": {"cycle_year": "cycle_year BETWEEN 1960 AND 2040"},
    "fact_acs_estimate": {"reliability": "reliability IN ('high', 'medium', 'low', 'suppressed')"},
    "fact_urbanicity": {
        "locale_code": "locale_code BETWEEN 11 AND 43",
        "method": "method IN ('direct', 'overlay', 'majority')",
        "confidence": "confidence BETWEEN 0 AND 1",
    },
    "fact_election_result": {
        "office": "office IN ('president', 'senate', 'house', 'governor', 'state_senate', 'state_house')",
        "vote_share": "vote_share BETWEEN 0 AND 1",
    },
    "fact_precinct_result": {
        "office": "office IN ('president', 'senate', 'house', 'governor', 'state_senate', 'state_house', "
        "'attorney_general', 'secretary_of_state')",
        "vote_share": "vote_share BETWEEN 0 AND 1",
    },
    "fact_redistricting_plan": {
        "chamber": "chamber IN ('congress', 'state_senate', 'state_house')",
        "plan_type": "plan_type IN ('enacted', 'proposed', 'alternative', 'court_ordered', 'commission')",
        "polsby_popper": "polsby_popper BETWEEN 0 AND 1",
        "reock": "reock BETWEEN 0 AND 1",
    },
}

# Natural keys.
KEYS = {
    "dim_geography": ["geoid", "vintage_year"],
    "dim_survey": ["survey_type", "vintage_year"],
    "dim_census_variable": ["variable_code", "dataset"],
    "dim_time": ["calendar_date"],
    "dim_redistricting_cycle": ["cycle_year"],
    "fact_acs_estimate": ["geography_key", "variable_key", "survey_key"],
    "fact_decennial_count": ["geography_key", "variable_key", "survey_key"],
    "fact_urbanicity": ["geography_key", "nces_year", "method"],
    "fact_election_result": ["geography_key", "election_date", "office", "party", "candidate_name"],
    "fact_precinct_result": ["geography_key", "election_date", "office", "party", "candidate_name"],
    "address_boundary_period": ["address_id", "vintage", "redistricting_plan"],
    "county_cd_intersection": ["county_geoid", "cd_geoid", "year"],
    "vtd_cd_intersection": ["vtd_geoid", "cd_geoid", "year"],
}


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; nulls are one value."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def violations(df: DataFrame, rules: dict[str, str], keep: list[str]) -> DataFrame:
    """One row per broken rule: the `keep` columns and the rule's name. A null value breaks none."""
    broken = F.array_compact(F.array(*[F.when(~F.expr(cond), F.lit(name)) for name, cond in rules.items()]))
    return df.select(*keep, F.explode(broken).alias("rule"))


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str]) -> DataFrame:
    """Child rows whose non-null reference has no parent row."""
    cond = F.lit(True)
    for c, p in on.items():
        cond = cond & (F.col(f"c.{c}") == F.col(f"p.{p}"))
    referenced = child
    for c in on:
        referenced = referenced.filter(F.col(c).isNotNull())
    return referenced.alias("c").join(parent.select(*set(on.values())).alias("p"), cond, "left_anti")

"""Star schema loads: dimensions, survey facts, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions import measures as m
from plumbline.functions import text as t
from plumbline.functions.calendar import redistricting_cycles, time_dimension
from plumbline.operators.history import validity_windows
from plumbline.operators.hull import reock_scores
from plumbline.operators.pivot import to_long
from plumbline.operators.upsert import insert_if_absent, merge_upsert, upsert_table
from plumbline.session import spool
from plumbline.sources.lake import exists, replace_table

# Survey variable groups.
VARIABLE_GROUPS = {
    "population": ["B01001_001E"],
    "race": [
        "B02001_002E", "B02001_003E", "B02001_004E", "B02001_005E", "B02001_006E", "B02001_007E", "B02001_008E",
    ],
    "hispanic": ["B03003_003E"],
    "income": ["B19013_001E"],
    "poverty": ["B17001_002E"],
    "housing": ["B25001_001E", "B25002_002E", "B25002_003E"],
    "education": ["B15003_022E", "B15003_023E", "B15003_024E", "B15003_025E"],
}

# What the tables of the variable groups hold; medians cannot be summed.
TABLE_TYPES = {
    "B01001": "extensive",
    "B01002": "intensive",
    "B02001": "extensive",
    "B03003": "extensive",
    "B19013": "intensive",
    "B17001": "extensive",
    "B25001": "extensive",
    "B25002": "extensive",
    "B15003": "extensive",
    "P1": "extensive",
    "P2": "extensive",
}

# Decennial count variables.
DECENNIAL_VARIABLES = ["P1_001N", "P1_003N", "P1_004N", "P2_002N"]

# Boundary levels of the geography dimension.
SUMMARY_LEVELS = ["state", "county", "tract", "block_group", "place", "cd", "vtd", "sldu", "sldl"]


def surrogate_key(*natural: str) -> Column:
    """A key computed from the natural key, the same in every load and without a global sort."""
    return F.xxhash64(*natural)


def resolve_variables(groups: list[str] | None = None) -> list[str]:
    """Variable codes of the groups; an unknown name is taken as a code."""
    names = list(VARIABLE_GROUPS) if groups is None else groups
    return [code for name in names for code in VARIABLE_GROUPS.get(name, [name])]


def geography_dimension(levels: dict[str, DataFrame], vintage_year: int) -> DataFrame:
    """One row per boundary of the known levels, with its parent's key and validity.

    Each frame has geoid, name and optionally state_fips, area_land, area_water,
    internal_point and rings. Unknown levels are an error.
    """
    unknown = set(levels) - set(SUMMARY_LEVELS)
    if unknown:
        raise ValueError(f"unknown summary levels {sorted(unknown)}; known: {SUMMARY_LEVELS}")
    shaped = [
        df.withColumns({"summary_level": F.lit(level), "vintage_year": F.lit(vintage_year)}) for level, df in levels.items()
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)
    return with_parents(rows)


def with_parents(rows: DataFrame) -> DataFrame:
    """Adds `geography_key`, `parent_geoid` and `parent_key` (null when the parent is not in the table)."""
    rows = rows.withColumn("geography_key", surrogate_key("geoid", "vintage_year")).withColumn(
        "_parent", t.parent_geoid("geoid", "summary_level")
    )
    parents = rows.select(
        F.col("geoid").alias("parent_geoid"), F.col("vintage_year").alias("_vintage"), F.col("geography_key").alias("parent_key")
    )
    same = (rows["_parent"] == parents["parent_geoid"]) & (rows["vintage_year"] == parents["_vintage"])
    return rows.join(parents, same, "left").drop("_parent", "_vintage")


def load_geography(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Merge boundary rows into the dimension and renew the validity of all versions."""
    if exists(spark, path):
        known = spark.read.parquet(path).drop("effective_from", "effective_to", "is_current")
        rows = merge_upsert(known, rows, ["geoid", "vintage_year"])
    replace_table(validity_windows(rows), path)
    return spark.read.parquet(path)


def survey_dimension(spark: SparkSession, survey_type: str, vintage_year: int) -> DataFrame:
    names = {"acs5": "ACS 5-Year", "acs1": "ACS 1-Year", "decennial": "Decennial Census", "decennial_pl": "Decennial PL 94-171"}
    row = [(survey_type, vintage_year, f"{names[survey_type]} {vintage_year}")]
    df = spark.createDataFrame(row, "survey_type string, vintage_year int, description string")
    return df.withColumn("survey_key", surrogate_key("survey_type", "vintage_year"))


def variable_dimension(spark: SparkSession, codes: list[str], dataset: str, types: dict[str, str] | None = None) -> DataFrame:
    """Variables with their table id (text before `_`) and type.

    `types` gives extensive (can be summed) or intensive by code or table id, in
    addition to TABLE_TYPES; any other variable has a null type and is not summed.
    """
    known = TABLE_TYPES | (types or {})
    rows = [(c, dataset, known.get(c, known.get(c.split("_")[0]))) for c in codes]
    df = spark.createDataFrame(rows, "variable_code string, dataset string, variable_type string")
    return df.select(
        "variable_code",
        "dataset",
        F.substring_index("variable_code", "_", 1).alias("table_id"),
        F.col("variable_code").alias("label"),
        "variable_type",
        t.is_estimate("variable_code").alias("is_estimate"),
        t.is_moe("variable_code").alias("is_moe"),
        surrogate_key("variable_code", "dataset").alias("variable_key"),
    )


def _geoid(rows: DataFrame) -> Column:
    names = [c for c in ("GEO_ID", "geoid") if c in rows.columns]
    return t.last_pipe_part(F.coalesce(*[t.non_blank(c) for c in names]))


def _long_cells(rows: DataFrame, codes: list[str]) -> DataFrame:
    keyed = rows.withColumn("_geoid", _geoid(rows)).filter(F.col("_geoid").isNotNull() & (F.col("_geoid") != ""))
    return to_long(keyed, ["_geoid"], codes).withColumnRenamed("_geoid", "geoid")


def acs_estimates(rows: DataFrame, geography: DataFrame, vintage_year: int, groups: list[str] | None = None) -> DataFrame:
    """Facts from wide survey rows: estimate, margin, variation, reliability and the three keys.

    Rows of geographies that are not in the dimension are left out, and so are
    cells that are missing or unreadable (in the estimate or in the margin).
    """
    cells = _long_cells(rows, resolve_variables(groups))
    marker = F.col("moe_value").isNull() | F.trim("moe_value").isin(*m.NULL_MARKERS, "")
    cells = cells.select(
        "geoid", "variable_code", m.clean_number("value").alias("estimate"),
        m.clean_number("moe_value").alias("margin_of_error"), marker.alias("_no_moe"),
    ).filter("estimate IS NOT NULL AND (margin_of_error IS NOT NULL OR _no_moe)")
    dim = geography.filter(F.col("vintage_year") == vintage_year).select("geoid", "geography_key")
    cv = m.coefficient_of_variation("estimate", "margin_of_error")
    return cells.join(dim, "geoid").select(
        "geography_key",
        surrogate_key("variable_code", F.lit("acs5")).alias("variable_key"),
        surrogate_key(F.lit("acs5"), F.lit(vintage_year)).alias("survey_key"),
        "geoid",
        "variable_code",
        F.lit(vintage_year).alias("vintage_year"),
        "estimate",
        "margin_of_error",
        cv.alias("coefficient_of_variation"),
        m.reliability(cv).alias("reliability"),
    )


def decennial_counts(rows: DataFrame, geography: DataFrame, census_year: int, codes: list[str] | None = None) -> DataFrame:
    """Facts from wide decennial rows: whole counts, no sampling error."""
    cells = _long_cells(rows, codes or DECENNIAL_VARIABLES).select(
        "geoid", "variable_code", m.clean_number("value", "bigint").alias("count")
    ).filter("count IS NOT NULL")
    dim = geography.filter(F.col("vintage_year") == census_year).select("geoid", "geography_key")
    return cells.join(dim, "geoid").select(
        "geography_key",
        surrogate_key("variable_code", F.lit("decennial_pl")).alias("variable_key"),
        surrogate_key(F.lit("decennial_pl"), F.lit(census_year)).alias("survey_key"),
        "geoid",
        "variable_code",
        F.lit(census_year).alias("vintage_year"),
        "count",
    )


def fact_view(facts: DataFrame, geography: DataFrame, variables: DataFrame, surveys: DataFrame) -> DataFrame:
    """Facts with the geoid, name, variable code and survey type in place of keys."""
    return (
        facts.drop("geoid", "variable_code", "vintage_year")
        .join(geography.select("geography_key", "geoid", "name"), "geography_key")
        .join(variables.select("variable_key", "variable_code"), "variable_key")
        .join(surveys.select("survey_key", "survey_type", "vintage_year"), "survey_key")
        .drop("geography_key", "variable_key", "survey_key")
    )


def vote_shares(results: DataFrame, contest: list[str]) -> DataFrame:
    """Adds `total_votes` and `vote_share` within a contest.

    The totals are aggregated first and joined back, so a contest with very many rows
    is never collected in one task.
    """
    totals = results.groupBy(*contest).agg(F.sum("votes").alias("total_votes"))
    return results.drop("total_votes", "vote_share").join(totals, contest).withColumn(
        "vote_share", F.col("votes") / F.nullif(F.col("total_votes").cast("double"), F.lit(0.0))
    )


def district_deviation(districts: DataFrame, plan: list[str]) -> DataFrame:
    """Adds `deviation_pct`: percent above or below the mean population of the plan's districts."""
    ideal = districts.groupBy(*plan).agg(F.avg("total_population").alias("_ideal"))
    return districts.join(ideal, plan).withColumn(
        "deviation_pct", (F.col("total_population") - F.col("_ideal")) / F.nullif("_ideal", F.lit(0.0)) * 100
    ).drop("_ideal")


def redistricting_plan_facts(districts: DataFrame, plan: list[str], key: str = "geoid") -> DataFrame:
    """Districts with `deviation_pct` within their plan, `polsby_popper` and `reock`.

    `districts` has a unique `key`, the `plan` columns, `total_population` and `rings` in a plane.
    """
    scored = district_deviation(districts, plan).withColumn("polsby_popper", F.expr(g.polsby_popper("rings")))
    return scored.drop("rings").join(reock_scores(districts, key), key)


def roll_up(facts: DataFrame, variables: DataFrame, value: str = "estimate") -> DataFrame:
    """Sums of the extensive variables by state, county and tract code prefixes.

    `level` is state, county or tract. Variables that cannot be summed are left
    out. Each task sums its own rows per level before anything is sent on.
    """
    summed = facts.join(
        variables.filter("variable_type = 'extensive'").select("variable_code"), "variable_code", "left_semi"
    )
    levels = F.array(
        *[
            F.struct(F.lit(level).alias("level"), F.substring("geoid", 1, n).alias("geoid"))
            for level, n in t.PARENT_LENGTHS.items()
        ]
    )
    rows = summed.select("variable_code", value, F.explode(levels).alias("_l")).select("variable_code", value, "_l.*")
    return rows.groupBy("variable_code", "level", "geoid").agg(F.sum(value).alias(value))


def ancestors(geographies: DataFrame, key: str = "geography_key", parent: str = "parent_key") -> DataFrame:
    """`key, ancestor` of every geography, itself included, along its chain of parents.

    Found by pointer doubling: each round joins the ancestors known so far with
    a jump twice as long, so a chain of n parents takes log2(n) rounds. Raises
    ValueError where parents form a circle.
    """
    edges = spool(geographies.filter(F.col(parent).isNotNull()).select(F.col(key).alias("k"), F.col(parent).alias("a")).distinct(), "parents")
    if not edges.groupBy("k").count().filter("count > 1").isEmpty():
        raise ValueError("a geography has several parents")
    limit = max(1, edges.count())
    own = geographies.select(F.col(key).alias("k")).union(edges.select("a")).distinct()
    known, jump, span = own.select("k", F.col("k").alias("a")), edges, 1
    while not jump.isEmpty():
        if span > limit:
            raise ValueError("the parents of a geography form a circle")
        far = jump.select(F.col("k").alias("a"), F.col("a").alias("b"))
        # All ancestors nearer than `span`, and those as far again beyond the jump.
        known = spool(known.union(known.join(far, "a").select("k", F.col("b").alias("a"))), "ancestors")
        jump = spool(jump.join(far, "a").select("k", F.col("b").alias("a")), "jumps")
        span *= 2
    return known.select(F.col("k").alias(key), F.col("a").alias("ancestor"))


def roll_up_parents(
    facts: DataFrame, geographies: DataFrame, variables: DataFrame, *, key: str = "geography_key", parent: str = "parent_key", value: str = "estimate"
) -> DataFrame:
    """`key, variable_code, value` of every geography with facts at or below it, along `parent`.

    Extensive variables are summed. An intensive one with a `weight_code` is the
    mean of its values weighted by that variable's at the same geography, over
    the geographies that have both; one without stays out. `facts` are those of
    the lowest geographies, so that nothing counts twice.
    """
    kinds = variables.select("variable_code", "variable_type", "weight_code")
    rows = facts.select(F.col(key), "variable_code", F.col(value).cast("double").alias("_v")).join(kinds, "variable_code")
    weights = facts.select(F.col(key), F.col("variable_code").alias("weight_code"), F.col(value).cast("double").alias("_w"))
    weighted = rows.filter("variable_type = 'intensive' AND weight_code IS NOT NULL").join(weights, [key, "weight_code"])
    each = rows.filter("variable_type = 'extensive'").select(key, "variable_code", "_v", F.lit(None).cast("double").alias("_w"))
    each = each.unionByName(weighted.filter("_v IS NOT NULL AND _w IS NOT NULL").select(key, "variable_code", (F.col("_v") * F.col("_w")).alias("_v"), "_w"))
    above = each.join(ancestors(geographies, key, parent), key)
    sums = above.groupBy(F.col("ancestor").alias(key), "variable_code").agg(F.sum("_v").alias("_v"), F.sum("_w").alias("_w"))
    return sums.select(key, "variable_code", F.when(F.col("_w").isNull(), F.col("_v")).otherwise(F.try_divide("_v", "_w")).alias(value))


def urbanicity_facts(overlaps: DataFrame, nces_year: int) -> DataFrame:
    """Locale of each geography from an area overlay: the code with the largest share of the area.

    `overlaps` has geography_key, locale_code and overlap_area; the confidence
    is the share of the overlaid area.
    """
    by_code = overlaps.groupBy("geography_key", "locale_code").agg(F.sum("overlap_area").alias("_a"))
    best = by_code.groupBy("geography_key").agg(
        F.min(F.struct(F.col("_a").isNull().alias("n"), (-F.col("_a")).alias("a"), F.col("locale_code").alias("c"))).alias("_b"),
        F.sum("_a").alias("_t"),
    )
    code = F.col("_b.c")
    return best.select(
        "geography_key",
        F.lit(nces_year).alias("nces_year"),
        code.alias("locale_code"),
        m.locale_category(code).alias("locale_category"),
        m.locale_subcategory(code).alias("locale_subcategory"),
        F.lit("majority").alias("method"),
        (-F.col("_b.a") / F.col("_t")).alias("confidence"),
    )


def load_warehouse(
    spark: SparkSession,
    root: str,
    *,
    levels: dict[str, DataFrame],
    plans: DataFrame | None = None,
    acs_rows: DataFrame | None = None,
    decennial_rows: DataFrame | None = None,
    boundary_year: int = 2020,
    acs_year: int = 2022,
    groups: list[str] | None = None,
    years: tuple[int, int] = (2000, 2030),
) -> dict[str, DataFrame]:
    """Dimensions, then facts, each merged into its table under `root`; returns the tables."""
    out = {}

    def put(name: str, df: DataFrame, keys: list[str], parts: list[str] | None = None) -> None:
        out[name] = upsert_table(spark, f"{root}/{name}", df, keys, parts)

    put("dim_time", time_dimension(spark, *years), ["calendar_date"])
    # The facts look geographies up under their own year, so the boundaries are loaded for each.
    rows = geography_dimension(levels, boundary_year)
    if acs_rows is not None and acs_year != boundary_year:
        rows = rows.unionByName(geography_dimension(levels, acs_year))
    out["dim_geography"] = load_geography(spark, f"{root}/dim_geography", rows)
    if plans is not None:
        put("dim_redistricting_cycle", redistricting_cycles(plans), ["cycle_year"])
    surveys, variables = [], []
    if acs_rows is not None:
        surveys.append(survey_dimension(spark, "acs5", acs_year))
        variables.append(variable_dimension(spark, resolve_variables(groups), "acs5"))
        facts = acs_estimates(acs_rows, out["dim_geography"], acs_year, groups)
        put("fact_acs_estimate", facts, ["geography_key", "variable_key", "survey_key"])
    if decennial_rows is not None:
        surveys.append(survey_dimension(spark, "decennial_pl", boundary_year))
        variables.append(variable_dimension(spark, DECENNIAL_VARIABLES, "decennial_pl"))
        facts = decennial_counts(decennial_rows, out["dim_geography"], boundary_year)
        put("fact_decennial_count", facts, ["geography_key", "variable_key", "survey_key"])
    if surveys:
        put("dim_survey", reduce(DataFrame.unionByName, surveys), ["survey_type", "vintage_year"])
        put("dim_census_variable", reduce(DataFrame.unionByName, variables), ["variable_code", "dataset"])
    return out


def add_new_variables(known: DataFrame, variables: DataFrame) -> DataFrame:
    return insert_if_absent(known, variables, ["variable_code", "dataset"])

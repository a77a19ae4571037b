"""Codes, dates, history, temporal joins, merges and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import calendar as cal
from plumbline.functions import measures as m
from plumbline.functions import text as t
from plumbline.operators import history, quality, temporal, upsert
from plumbline.plans import assignment
from plumbline.queries import bindings as b
from plumbline.queries.registration import Registry
from plumbline.session import new_path
from plumbline.sources.plans import typed_plans

query = Registry()


# --- Codes and addresses ---

_FIPS = (
    f"SELECT c_custkey AS id, {b.pad('c_nationkey', 2)} AS st, CASE WHEN c_custkey % 7 <> 0 THEN {b.pad('c_custkey % 999', 3)} END AS co, "
    f"CASE WHEN c_custkey % 5 <> 0 THEN {b.pad('c_custkey * 31 % 999999', 6)} ELSE '' END AS tr, "
    f"CASE WHEN c_custkey % 3 <> 0 THEN {b.pad('c_custkey * 17 % 9999', 4)} END AS bl FROM {{customer}}"
)


@query(
    f"""WITH f AS (SELECT id, st, co, nullif(tr, '') AS tr, bl FROM ({_FIPS.format(customer='customer')}))
    SELECT id, st AS state_geoid, st || co AS county_geoid, st || co || tr AS tract_geoid, st || co || tr || coalesce(substr(bl, 1, 1), '') AS block_group_geoid,
    st || co || tr || bl AS block_geoid FROM f"""
)
def geoids_from_parts(spark, sf):
    rows = b.sql(spark, sf, _FIPS, "customer")
    return rows.select("id", *[c.alias(n) for n, c in t.geoids_from_fips("st", "co", "tr", "bl").items()])


_STREETS = (
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey AS VARCHAR(20)) ELSE '' END AS primary_number, c_mktsegment AS street_name, "
    "CASE WHEN c_custkey % 2 = 0 THEN 'St' END AS street_suffix, CASE WHEN c_custkey % 6 <> 0 THEN c_name ELSE '' END AS city_name, "
    f"CASE WHEN c_custkey % 4 <> 0 THEN {b.pad('c_nationkey', 2)} END AS state_abbreviation, {b.pad('c_custkey % 99999', 5)} AS zip5, "
    "c_custkey % 3 <> 0 AS geocoded FROM {customer}"
)


@query(
    f"""SELECT CAST(id AS VARCHAR) AS id, concat_ws(' ', nullif(primary_number, ''), street_name, street_suffix) AS street, coalesce(city_name, '') AS city,
    coalesce(state_abbreviation, '') AS state, zip5 AS zipcode, concat_ws(', ', concat_ws(' ', nullif(primary_number, ''), street_name, street_suffix),
    nullif(city_name, ''), state_abbreviation, zip5) AS one_line FROM ({_STREETS.format(customer='customer')}) WHERE NOT geocoded"""
)
def geocoder_input(spark, sf):
    from plumbline.plans.geocoding import batch_input, geocode_queue

    return batch_input(geocode_queue(b.sql(spark, sf, _STREETS, "customer")))


_LINES = (
    "SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN concat(c_name, ' St, Springfield , IL  ', CAST(10000 + c_custkey AS VARCHAR(20))) "
    "WHEN 1 THEN concat(c_name, ', Springfield IL') WHEN 2 THEN concat(c_name, ', Springfield, IL') ELSE c_name END AS line FROM {customer}"
)


@query(
    f"""WITH p AS (SELECT id, line, string_split(line, ',') AS a FROM ({_LINES.format(customer='customer')})),
    q AS (SELECT *, len(a) AS n, string_split_regex(trim(a[3]), '\\s+') AS z FROM p)
    SELECT id, CASE WHEN n >= 2 THEN trim(a[1]) END AS street, CASE WHEN n >= 3 THEN trim(a[2]) END AS city, CASE WHEN n >= 3 THEN z[1] END AS state,
    CASE WHEN n >= 3 THEN z[2] END AS zip, CASE WHEN n = 2 THEN trim(a[2]) END AS city_state_zip, CASE WHEN n < 2 THEN line END AS raw FROM q"""
)
def address_parts(spark, sf):
    return b.sql(spark, sf, _LINES, "customer").select("id", t.split_address("line").alias("p")).select("id", "p.*")


@query(
    """SELECT p_partkey AS id, lpad(CAST(p_size AS VARCHAR), 3, '0') AS code, upper(trim(concat(' ', p_brand, ' '))) AS brand,
    split_part(concat('0500000US|', CAST(p_partkey AS VARCHAR)), '|', -1) AS geoid, concat('B', CAST(p_partkey AS VARCHAR), 'E_001M') AS moe,
    p_partkey % 2 = 0 AS is_estimate FROM part"""
)
def code_texts(spark, sf):
    parts = b.read(spark, sf, "part")
    code = F.concat(F.lit("B"), F.col("p_partkey"), F.lit("E_001E"))
    kind = F.when(F.col("p_partkey") % 2 == 0, code).otherwise(t.moe_code(code))
    return parts.select(
        F.col("p_partkey").alias("id"), t.zero_pad("p_size", 3).alias("code"),
        F.upper(F.trim(F.concat(F.lit(" "), "p_brand", F.lit(" ")))).alias("brand"),
        t.last_pipe_part(F.concat(F.lit("0500000US|"), F.col("p_partkey"))).alias("geoid"),
        t.moe_code(code).alias("moe"), t.is_estimate(kind).alias("is_estimate"),
    )


@query(
    """SELECT p_partkey AS id, 10 * (1 + p_partkey % 4) + 1 + p_partkey % 3 AS locale_code,
    ['city', 'suburban', 'town', 'rural'][1 + p_partkey % 4] AS locale_category,
    CASE WHEN p_partkey % 4 < 2 THEN ['large', 'midsize', 'small'][1 + p_partkey % 3] ELSE ['fringe', 'distant', 'remote'][1 + p_partkey % 3] END AS locale_subcategory FROM part"""
)
def locale_classes(spark, sf):
    code = (F.lit(10) * (1 + F.col("p_partkey") % 4) + 1 + F.col("p_partkey") % 3).alias("locale_code")
    rows = b.read(spark, sf, "part").select(F.col("p_partkey").alias("id"), code)
    return rows.withColumns(
        {"locale_category": m.locale_category("locale_code"), "locale_subcategory": m.locale_subcategory("locale_code")}
    )


# --- Dates ---


@query(
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), e AS (SELECT d, month(d) = 11 AND isodow(d) = 2 AND day(d) BETWEEN 2 AND 8 AS el FROM d)
    SELECT d AS calendar_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day_of_month, dayofyear(d) AS day_of_year,
    isodow(d) - 1 AS day_of_week, week(d) AS week_of_year, el AS is_election_day, el AND year(d) % 4 = 0 AS is_presidential_election,
    el AND year(d) % 4 = 2 AS is_midterm_election, month(d) = 4 AND day(d) = 1 AND year(d) % 10 = 0 AS is_census_day,
    CASE WHEN month(d) >= 10 THEN year(d) + 1 ELSE year(d) END AS fiscal_year, CASE WHEN month(d) >= 10 THEN year(d) + 1 ELSE year(d) END AS federal_fiscal_year FROM e"""
)
def calendar_of_orders(spark, sf):
    days = b.read(spark, sf, "orders").select(F.to_date("o_orderdate").alias("calendar_date")).distinct()
    return cal.calendar_attributes(days)


@query(
    """SELECT DISTINCT CAST(floor(year(o_orderdate) / 10) * 10 AS INT) AS cycle_year, CAST(floor(year(o_orderdate) / 10) * 10 AS INT) AS decennial_census_year,
    CAST(floor(year(o_orderdate) / 10) * 10 + 2 AS INT) AS first_election_year, make_date(CAST(floor(year(o_orderdate) / 10) * 10 + 2 AS INT), 1, 1) AS effective_start,
    make_date(CAST(floor(year(o_orderdate) / 10) * 10 + 12 AS INT), 1, 1) AS effective_end FROM orders"""
)
def redistricting_cycles(spark, sf):
    plans = b.read(spark, sf, "orders").select((F.floor(F.year("o_orderdate") / 10) * 10).alias("cycle_year"))
    return cal.redistricting_cycles(plans).drop("census_year")


_DATES = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN concat(o_orderpriority, '!') ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) END AS text FROM {orders}"


@query(f"SELECT id, TRY_CAST(text AS DATE) AS day FROM ({_DATES.format(orders='orders')})")
def iso_dates(spark, sf):
    return b.sql(spark, sf, _DATES, "orders").select("id", cal.iso_date("text").alias("day"))


# Court and legislature plan windows (state, chamber, cycle, name, type, start, end).
COURT_PLANS = [
    ("01", "congress", 2020, "2021 Alabama Enacted Congressional Plan", "enacted", "2022-01-01", "2023-06-08"),
    ("01", "congress", 2020, "Allen v. Milligan Interim Plan", "court_ordered", "2023-06-08", "2023-10-05"),
    ("01", "congress", 2020, "Allen v. Milligan Final Plan", "court_ordered", "2023-10-05", None),
    ("22", "congress", 2020, "2022 Louisiana Enacted Congressional Plan", "enacted", "2022-01-01", "2024-01-15"),
    ("22", "congress", 2020, "Robinson v. Ardoin Court-Ordered Plan", "court_ordered", "2024-01-15", None),
    ("36", "congress", 2020, "2022 New York Enacted Congressional Plan", "enacted", "2022-01-01", "2022-04-27"),
    ("36", "congress", 2020, "2022 NY Court-Drawn Congressional Plan", "court_ordered", "2022-05-20", "2024-02-28"),
    ("36", "congress", 2020, "2024 NY Legislature Congressional Plan", "enacted", "2024-02-28", None),
    ("13", "congress", 2020, "2021 Georgia Enacted Congressional Plan", "enacted", "2022-01-01", "2023-10-26"),
    ("13", "congress", 2020, "Alpha Phi Alpha v. Raffensperger Court-Ordered Plan", "court_ordered", "2023-10-26", None),
]


def court_plans(spark):
    names = ["state_fips", "chamber", "cycle_year", "plan_name", "plan_type", "effective_from", "effective_to"]
    rows = [dict(zip(names, r)) for r in COURT_PLANS]
    raw = spark.createDataFrame(rows, "state_fips string, chamber string, cycle_year int, plan_name string, plan_type string, effective_from string, effective_to string")
    missing = {c: F.lit(None).cast("string") for c in ("source", "num_districts", "enacted_date", "court_case", "data_source")}
    return typed_plans(raw.withColumns(missing))


def _plan_values() -> str:
    def lit(v):
        return "CAST(NULL AS VARCHAR)" if v is None else f"'{v}'"

    return ", ".join(f"({lit(p[0])}, {lit(p[3])}, CAST({lit(p[5])} AS DATE), CAST({lit(p[6])} AS DATE))" for p in COURT_PLANS)


_DATED = (
    "SELECT o_orderkey AS id, CASE o_custkey % 5 WHEN 0 THEN '01' WHEN 1 THEN '22' WHEN 2 THEN '36' WHEN 3 THEN '13' ELSE '51' END AS state_fips, "
    "CAST('2021-12-01' AS DATE) + CAST(o_orderkey % 900 AS INT) AS day FROM {orders}"
)


@query(
    f"""WITH d AS ({_DATED.format(orders='orders')}), p(st, plan_name, a, z) AS (VALUES {_plan_values()})
    SELECT d.id, d.day, p.plan_name FROM d LEFT JOIN p ON st = state_fips AND day >= a AND (z IS NULL OR day <= z)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY a DESC) = 1"""
)
def plan_active_on_date(spark, sf):
    """Real plan windows: later plan on a hand-over day, none in a gap."""
    windows = temporal.plan_windows(court_plans(spark), ["state_fips", "chamber"])
    rows = b.sql(spark, sf, _DATED, "orders")
    return temporal.plan_on_date(rows, windows, "day", ["state_fips"], ["plan_name"]).select("id", "day", "plan_name")


@query(
    """SELECT o_orderkey AS id, CAST(CASE WHEN y BETWEEN 2010 AND 2019 THEN 2010 WHEN y BETWEEN 2020 AND 2029 THEN 2020 ELSE floor(y / 10) * 10 END AS INT) AS vintage
    FROM (SELECT o_orderkey, year(o_orderdate) + CAST(o_orderkey % 40 AS INT) AS y FROM orders)"""
)
def vintage_of_year(spark, sf):
    rows = b.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.year("o_orderdate") + (F.col("o_orderkey") % 40).cast("int")).alias("y")
    )
    return temporal.vintage_for_year(rows, temporal.default_vintages(spark), "y").select("id", "vintage")


@query(
    """SELECT o_orderkey AS id, CASE WHEN n % 2 = 0 AND n < 125 THEN make_date(CAST(1789 + (n - 1) * 2 AS INT), 1, 4) ELSE make_date(CAST(1789 + (n - 1) * 2 AS INT), 1, 3) END AS context_date
    FROM (SELECT o_orderkey, 100 + o_orderkey % 30 AS n FROM orders)"""
)
def congress_start(spark, sf):
    # Every second nation stands for a term that no row has.
    terms = b.read(spark, sf, "nation").selectExpr(
        "CASE WHEN n_nationkey % 2 = 0 THEN 100 + n_nationkey ELSE -n_nationkey END AS congress_number",
        "make_date(1789 + (99 + n_nationkey) * 2, 1, 4) AS start_date",
    )
    rows = b.read(spark, sf, "orders").selectExpr("o_orderkey AS id", "CAST(100 + o_orderkey % 30 AS INT) AS n")
    return temporal.term_start(rows, terms, "n").select("id", "context_date")


@query(
    """WITH r AS (SELECT event_id, ts, value, CASE WHEN event_type = 'signup' THEN user_id ELSE -1 - user_id END AS k FROM events)
    SELECT l.event_id AS id, r.event_id AS period_id, r.value AS period_value FROM events l LEFT JOIN r ON r.k = l.user_id AND r.ts <= l.ts
    QUALIFY row_number() OVER (PARTITION BY l.event_id ORDER BY r.ts DESC, r.event_id DESC) = 1"""
)
def boundary_as_of(spark, sf):
    """The last period that started at or before each row, per key."""
    events = b.read(spark, sf, "events")
    left = events.selectExpr("event_id AS id", "user_id", "ts")
    key = "CASE WHEN event_type = 'signup' THEN user_id ELSE -1 - user_id END AS user_id"
    right = events.selectExpr(key, "ts AS started", "event_id AS period_id", "value AS period_value")
    out = temporal.asof_join(
        left, right, key="user_id", left_ts="ts", right_ts="started", values=["period_id", "period_value"], tie=["period_id"]
    )
    return out.select("id", "period_id", "period_value")


# --- History ---


@query(
    """SELECT o_custkey AS geoid, y AS vintage_year, make_date(y, 1, 1) AS effective_from, CAST(make_date(lead(y) OVER w, 1, 1) - 1 AS DATE) AS effective_to,
    lead(y) OVER w IS NULL AS is_current FROM (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INT) AS y FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY y)"""
)
def version_windows(spark, sf):
    rows = b.read(spark, sf, "orders").select(F.col("o_custkey").alias("geoid"), F.year("o_orderdate").alias("vintage_year")).distinct()
    return history.validity_windows(rows)


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_order_per_customer(spark, sf):
    rows = b.read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return history.latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    """SELECT l_partkey AS source_geoid, l_suppkey AS target_geoid, w AS weight FROM (SELECT l_partkey, l_suppkey, sum(CASE WHEN l_discount > 0.02 THEN l_quantity END) AS w FROM lineitem GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY w DESC NULLS LAST, l_suppkey) = 1"""
)
def heaviest_target(spark, sf):
    weights = b.read(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("source_geoid"), F.col("l_suppkey").alias("target_geoid")).agg(
        F.sum(F.when(F.col("l_discount") > 0.02, F.col("l_quantity"))).alias("weight")
    )
    return history.best_by_weight(weights, "source_geoid", "target_geoid", "weight")


@query(
    """SELECT l_partkey, CAST(min(year(l_shipdate)) AS INT) AS tiger_first_seen_year, CAST(max(year(l_shipdate)) AS INT) AS tiger_last_seen_year,
    min(CAST(l_shipdate AS DATE)) AS first_seen_date FROM lineitem GROUP BY 1"""
)
def sightings(spark, sf):
    rows = b.read(spark, sf, "lineitem").select("l_partkey", F.year("l_shipdate").alias("y"), F.to_date("l_shipdate").alias("d"))
    return history.sighting_range(rows, "l_partkey", "y", "d")


# --- Merges ---

_OLD = "SELECT o_custkey AS k, o_orderpriority AS p, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS s FROM {orders} WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2"
_NEW = "SELECT o_custkey AS k, o_orderpriority AS p, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS s FROM {orders} WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1, 2"
_BOTH = f"WITH o AS ({_OLD.format(orders='orders')}), w AS ({_NEW.format(orders='orders')}) "


def _old_new(spark, sf):
    return b.sql(spark, sf, _OLD, "orders"), b.sql(spark, sf, _NEW, "orders")


@query(_BOTH + "SELECT * FROM w UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.k = o.k AND w.p = o.p)")
def merged_rows(spark, sf):
    old, new = _old_new(spark, sf)
    return upsert.merge_upsert(old, new, ["k", "p"])


@query(_BOTH + "SELECT * FROM o UNION ALL SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM o WHERE w.k = o.k AND w.p = o.p)")
def inserted_if_absent(spark, sf):
    old, new = _old_new(spark, sf)
    return upsert.insert_if_absent(old, new, ["k", "p"])


@query(_BOTH + "SELECT * FROM w UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM w WHERE w.k = o.k AND w.p = o.p)")
def merged_table(spark, sf):
    """The merge on a stored table, twice: the second time changes nothing."""
    old, new = _old_new(spark, sf)
    path = new_path(spark, "table")
    for rows in (old, new, new):
        upsert.upsert_table(spark, path, rows, ["k", "p"], ["p"])
    return spark.read.schema(old.schema).parquet(path)


@query(
    f"""SELECT {b.pad('c_nationkey', 2)} AS st, c_custkey AS id, max(CASE WHEN v = 1 THEN c_acctbal + 1 ELSE c_acctbal END) AS amount
    FROM customer, (SELECT unnest([0, 1]) AS v) WHERE v = 0 OR c_custkey % 3 = 0 GROUP BY 1, 2"""
)
def merged_code_partitions(spark, sf):
    """Merges into partitions named by codes with leading zeros; source keys come twice and every merge is run twice."""
    rows = b.read(spark, sf, "customer").selectExpr(f"{b.pad('c_nationkey', 2)} AS st", "c_custkey AS id", "c_acctbal AS amount")
    changed = rows.filter("id % 3 = 0").select("st", "id", (F.col("amount") + 1).alias("amount")).unionByName(rows.filter("id % 3 = 0"))
    path = new_path(spark, "codes")
    for part in (rows, changed, changed):
        out = upsert.upsert_table(spark, path, part, ["id", "st"], ["st"])
    return out.select("st", "id", "amount")


@query("SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def updated_rows(spark, sf):
    rows = b.read(spark, sf, "customer").selectExpr("c_custkey AS id", "c_acctbal")
    return upsert.update_rows(rows, "c_acctbal < 0", {"c_acctbal": F.lit(0.0)})


# Customers of orders that are not urgent get a key that no customer has.
_URGENT_KEY = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE -1 - o_custkey END"


@query(
    """SELECT c_custkey, coalesce(n, -1) AS n FROM customer LEFT JOIN (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE -1 - o_custkey END AS k, count(*) AS n FROM orders GROUP BY 1) ON k = c_custkey"""
)
def updated_from_join(spark, sf):
    counts = b.read(spark, sf, "orders").groupBy(F.expr(_URGENT_KEY).alias("c_custkey")).agg(F.count("*").alias("n"))
    return upsert.update_from(b.read(spark, sf, "customer").select("c_custkey"), counts, "c_custkey", {"n": -1})


# --- Checks ---


@query("SELECT l_orderkey, l_partkey, count(*) AS n FROM (SELECT l_orderkey, CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_partkey END AS l_partkey FROM lineitem) GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, sf):
    rows = b.read(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey")).alias("l_partkey"))
    return quality.duplicate_keys(rows, ["l_orderkey", "l_partkey"])


@query(
    """SELECT * FROM (SELECT p_partkey AS id, 'locale_code' AS rule FROM part WHERE p_size NOT BETWEEN 11 AND 43 UNION ALL
    SELECT p_partkey, 'method' FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO') UNION ALL SELECT p_partkey, 'confidence' FROM part WHERE p_retailprice / 1000 NOT BETWEEN 0 AND 1)"""
)
def broken_rules(spark, sf):
    rows = b.read(spark, sf, "part").selectExpr(
        "p_partkey AS id", "p_size AS locale_code", "CASE p_type WHEN 'ECONOMY' THEN 'direct' WHEN 'PROMO' THEN 'overlay' ELSE p_type END AS method",
        "p_retailprice / 1000 AS confidence",
    )
    return quality.violations(rows, quality.RULES["fact_urbanicity"], ["id"])


@query("SELECT c_custkey FROM customer WHERE c_acctbal >= 0 AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def dangling_references(spark, sf):
    child = b.read(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")).alias("ref"))
    parent = b.read(spark, sf, "orders").select(F.expr(_URGENT_KEY).alias("o_custkey"))
    return quality.orphans(child, parent, {"ref": "o_custkey"}).select("c_custkey")


# --- Address queues ---

_QUEUE = (
    "SELECT c_custkey AS id, c_custkey % 3 <> 0 AS geocoded, CASE WHEN c_custkey % 7 <> 0 THEN 1.5 END AS latitude, 2.5 AS longitude, "
    "CASE WHEN c_custkey % 5 = 0 THEN CAST('2024-01-01' AS DATE) END AS census_units_assigned_at, CASE c_nationkey % 2 WHEN 0 THEN 'VA' ELSE 'NC' END AS state_abbreviation, "
    "CASE WHEN c_custkey % 4 = 0 THEN 'census' ELSE 'other' END AS geocode_source FROM {customer}"
)


@query(
    f"""SELECT id FROM ({_QUEUE.format(customer='customer')}) WHERE geocoded AND latitude IS NOT NULL AND census_units_assigned_at IS NULL
    AND state_abbreviation = 'VA' AND geocode_source = 'census'"""
)
def assignment_queue(spark, sf):
    return assignment.assignment_queue(b.sql(spark, sf, _QUEUE, "customer"), state="va", source="census").select("id")


@query("SELECT o_orderpriority AS state_abbreviation, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def top_states(spark, sf):
    return assignment.top_states(b.read(spark, sf, "orders").withColumnRenamed("o_orderpriority", "state_abbreviation"))


_HOLDERS = "SELECT CASE WHEN n_nationkey = 7 THEN -7 ELSE n_nationkey END AS c_nationkey, concat('Gov ', n_name) AS governor, CASE WHEN n_nationkey % 2 = 0 THEN 'D' ELSE 'R' END AS party FROM {nation}"


@query(f"SELECT c_custkey AS id, governor, party FROM customer LEFT JOIN ({_HOLDERS.format(nation='nation')}) USING (c_nationkey)")
def office_holders(spark, sf):
    rows = b.read(spark, sf, "customer").selectExpr("c_custkey AS id", "c_nationkey")
    return assignment.political_context(rows, b.sql(spark, sf, _HOLDERS, "nation"), ["c_nationkey"]).select("id", "governor", "party")

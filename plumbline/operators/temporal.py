"""Joins on dates: plan windows, Census vintages, terms, as-of lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import spool

# Decade, first and last year, description, active flag.
DEFAULT_VINTAGES = [
    (1990, 1990, 1999, "1990 Census boundaries", False),
    (2000, 2000, 2009, "2000 Census boundaries", False),
    (2010, 2010, 2019, "2010 Census boundaries", True),
    (2020, 2020, 2029, "2020 Census boundaries", True),
]
VINTAGE_SCHEMA = "decade int, effective_start int, effective_end int, description string, is_active boolean"


def default_vintages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_VINTAGES, VINTAGE_SCHEMA)


def plan_windows(plans: DataFrame, keys: list[str], start: str = "effective_from", end: str = "effective_to") -> DataFrame:
    """Plans cut into windows that do not overlap within `keys`.

    Where several plans are active on a day the one that started last has it,
    so a join on a date finds at most one row. Adds `active_from, active_to`.
    """
    ends = plans.filter(F.col(end).isNotNull()).select(*keys, F.date_add(end, 1).alias("active_from"))
    starts = plans.select(*keys, F.col(start).alias("active_from"))
    by_key = Window.partitionBy(*keys).orderBy("active_from")
    slots = starts.union(ends).distinct().withColumn("active_to", F.date_sub(F.lead("active_from").over(by_key), 1))
    active = (F.col("s.active_from") >= F.col(f"p.{start}")) & (
        F.col(f"p.{end}").isNull() | (F.col("s.active_from") <= F.col(f"p.{end}"))
    )
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    cond = active
    for c in same:
        cond = c & cond
    row = F.struct(*[F.col(f"p.{c}").alias(c) for c in plans.columns])
    rest = [F.col(f"p.{c}") for c in plans.columns if c not in (start, *keys) and c != end]
    found = slots.alias("s").join(plans.alias("p"), cond).groupBy(
        *[F.col(f"s.{k}") for k in keys], F.col("s.active_from"), F.col("s.active_to")
    )
    best = found.agg(F.max_by(row, F.struct(F.col(f"p.{start}"), *rest)).alias("_plan"))
    return best.select(*[F.col(f"_plan.{c}").alias(c) for c in plans.columns], "active_from", "active_to")


def plan_on_date(rows: DataFrame, windows: DataFrame, date: str, keys: list[str], keep: list[str]) -> DataFrame:
    """Left join: the `keep` columns of the plan active on each row's date (`plan_windows` output).

    The keys make it an equi join, so the few plans can be broadcast when they are small
    and are shuffled with skew handling when they are not.
    """
    cond = (F.col(f"r.{date}") >= F.col("w.active_from")) & (
        F.col("w.active_to").isNull() | (F.col(f"r.{date}") <= F.col("w.active_to"))
    )
    for k in keys:
        cond = (F.col(f"r.{k}") == F.col(f"w.{k}")) & cond
    side = windows.select(*keys, *keep, "active_from", "active_to")
    joined = rows.alias("r").join(side.alias("w"), cond, "left")
    return joined.select(*[F.col(f"r.{c}") for c in rows.columns], *[F.col(f"w.{c}") for c in keep])


def vintage_for_year(rows: DataFrame, config: DataFrame, year: str, name: str = "vintage", fallback: bool = True) -> DataFrame:
    """Adds the decade of the active vintage whose years include `year`.

    The windows are unrolled into years, which turns the range join into an
    equi join. Without a match the year is rounded down to its decade, or left
    null when `fallback` is off.
    """
    years = (
        config.filter("is_active")
        .select("decade", F.explode(F.sequence("effective_start", "effective_end")).alias("_year"))
        .groupBy("_year")
        .agg(F.min("decade").alias("_decade"))
    )
    out = rows.join(years, F.col(year) == F.col("_year"), "left")
    decade = F.col("_decade")
    if fallback:
        decade = F.coalesce(decade, F.floor(F.col(year) / 10) * 10)
    return out.select(*rows.columns, decade.cast("int").alias(name))


def term_start(rows: DataFrame, terms: DataFrame, congress: str, name: str = "context_date") -> DataFrame:
    """Adds the start of a Congress; one not listed starts on January 3 of its first year."""
    known = terms.select(F.col("congress_number").alias("_n"), F.col("start_date").alias("_start"))
    computed = F.make_date(F.lit(1789) + (F.col(congress) - 1) * 2, F.lit(1), F.lit(3))
    return rows.join(known, F.col(congress) == F.col("_n"), "left").select(
        *rows.columns, F.coalesce("_start", computed).alias(name)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    key: str,
    left_ts: str,
    right_ts: str,
    values: list[str],
    tie: list[str] | None = None,
) -> DataFrame:
    """Left rows with the `values` of the latest right row of the same key at or before their time.

    Both sides are dealt out together in ranges of key and time, so a key with
    most of the rows, in whatever short time, takes as many ranges as it fills.
    Each range is scanned by itself; what the ranges before it end with is a
    table of one row a range, carried forward and broadcast. Right rows of equal
    time are ordered by `tie`. Left rows without key or time get nulls.
    """
    tie = tie or []
    placed = F.col(key).isNotNull() & F.col(left_ts).isNotNull()
    own = F.struct(*[F.col(c) for c in left.columns])
    payload = F.struct(*tie, *[F.col(v).alias(f"v_{v}") for v in values])
    r = right.filter(F.col(key).isNotNull() & F.col(right_ts).isNotNull())
    r = r.select(F.col(key).alias("_key"), F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), payload.alias("_payload"))
    lead = left.filter(placed).select(F.col(key).alias("_key"), F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), own.alias("_row"))
    # Rows that are equal up to here may stand in any order, but not all in one range.
    rows = lead.unionByName(r, allowMissingColumns=True).withColumn("_any", F.xxhash64("_row"))
    order = ["_key", "_ts", "_side", "_payload", "_any"]
    # With a number of its own the exchange isn't drawn together where one key is small in bytes.
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = spool(rows.repartitionByRange(parts, *order).withColumn("_slice", F.spark_partition_id()), "ranged")
    last = F.struct("_key", "_payload")
    ends = ranged.filter("_side = 0").groupBy("_slice").agg(F.max_by(last, F.struct("_key", "_ts", "_payload")).alias("_last"))
    slices = ranged.select("_slice").distinct().join(ends, "_slice", "left")
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select("_slice", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    within = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = F.last(F.when(F.col("_side") == 0, last), ignorenulls=True).over(within)
    found = ranged.withColumn("_seen", seen).filter("_side = 1").join(F.broadcast(carried), "_slice")
    newest = F.coalesce("_seen", "_carried")
    hit = F.when(newest["_key"] == F.col("_key"), newest["_payload"])
    out = found.withColumn("_hit", hit).select("_row.*", *[F.col(f"_hit.v_{v}").alias(v) for v in values])
    nowhere = left.filter(~placed)
    for v in values:
        nowhere = nowhere.withColumn(v, F.lit(None).cast(right.schema[v].dataType))
    return out.unionByName(nowhere)

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.functions import calendar as cal
from plumbline.functions import measures as m
from plumbline.functions import text as t
from plumbline.functions.projection import albers, lambert
from plumbline.operators import history, numbering, quality, temporal, upsert
from plumbline.session import spool
from plumbline.operators.components import connected_components
from plumbline.operators import components, skew
from plumbline.queries.records import court_plans


def one(spark, column, **values):
    return spark.createDataFrame([values]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "parts,expected",
    [
        (("11", "001", "006202", "1031"), ("11", "11001", "11001006202", "110010062021", "110010062021031")),
        (("06", "037", None, None), ("06", "06037", None, None, None)),
        (("06", "037", "123456", None), ("06", "06037", "06037123456", "06037123456", None)),
        (("", None, None, None), (None, None, None, None, None)),
    ],
)
def test_geoids(spark, parts, expected):
    df = spark.createDataFrame([parts], "s string, c string, t string, b string")
    row = df.select(*[c.alias(n) for n, c in t.geoids_from_fips("s", "c", "t", "b").items()]).first()
    assert tuple(row) == expected


@pytest.mark.parametrize(
    "line,expected",
    [
        ("123 Main St, Springfield, IL 62701", ("123 Main St", "Springfield", "IL", "62701", None, None)),
        ("1 Elm, Austin TX", ("1 Elm", None, None, None, "Austin TX", None)),
        ("nowhere", (None, None, None, None, None, "nowhere")),
        ("1 Elm, Austin, ", ("1 Elm", "Austin", None, None, None, None)),
        ("1 Elm, Austin, TX  78701, USA", ("1 Elm", "Austin", "TX", "78701", None, None)),
    ],
)
def test_split_address(spark, line, expected):
    assert tuple(one(spark, t.split_address("a"), a=line)) == expected


def test_parents(spark):
    rows = [("06037", "county", "06"), ("06", "state", None), ("06037123456", "tract", "06037"), ("060371234561", "block_group", "06037123456"), ("0", "county", None)]
    df = spark.createDataFrame(rows, "g string, l string, want string").withColumn("got", t.parent_geoid("g", "l"))
    assert all(r.got == r.want for r in df.collect())


def test_reliability(spark):
    rows = [(10000.0, 500.0, "high"), (100.0, 50.0, "medium"), (100.0, 90.0, "low"), (0.0, 5.0, "suppressed"), (10.0, None, "suppressed"), (10.0, 0.0, "high"), (-100.0, -50.0, "medium")]
    df = spark.createDataFrame(rows, "e double, m double, want string")
    cv = m.coefficient_of_variation("e", "m")
    got = df.select("want", cv.alias("cv"), m.reliability(cv).alias("r")).collect()
    assert all(r.r == r.want for r in got)
    assert got[0].cv == pytest.approx(3.04, abs=0.005)


def test_clean_number(spark):
    rows = [("12", 12.0), (" 3.5 ", 3.5), ("-", None), ("null", None), ("**", None), ("x", None), (None, None), ("NaN", None)]
    df = spark.createDataFrame(rows, "v string, want double").withColumn("got", m.clean_number("v"))
    assert all(r.got == r.want for r in df.collect())


def test_time_dimension(spark):
    days = {r.calendar_date: r for r in cal.time_dimension(spark, 2018, 2020).collect()}
    assert len(days) == 365 * 2 + 366
    assert [d for d, r in days.items() if r.is_election_day] == [dt.date(2018, 11, 6), dt.date(2019, 11, 5), dt.date(2020, 11, 3)]
    assert days[dt.date(2020, 11, 3)].is_presidential_election and days[dt.date(2018, 11, 6)].is_midterm_election
    assert [d for d, r in days.items() if r.is_census_day] == [dt.date(2020, 4, 1)]
    assert days[dt.date(2019, 10, 1)].fiscal_year == 2020 and days[dt.date(2019, 9, 30)].fiscal_year == 2019
    for d, r in days.items():
        assert (r.week_of_year, r.day_of_week, r.day_of_year) == (d.isocalendar()[1], d.weekday(), d.timetuple().tm_yday)


def test_projections_at_known_places(spark):
    df = spark.range(1).select(
        F.expr(albers("-96D", "23D")).alias("a0"), F.expr(albers("-77.0365D", "38.8977D")).alias("a1"), F.expr(lambert("-79.5D", "36D")).alias("l0"),
        F.expr(lambert("-79.5D", "37D")).alias("l1"),
    )
    r = df.first()
    assert (r.a0.x, r.a0.y) == pytest.approx((0, 0), abs=1e-6) and (r.l0.x, r.l0.y) == pytest.approx((0, 0), abs=1e-6)
    # The White House in the national equal-area projection, to a few metres.
    assert (r.a1.x, r.a1.y) == pytest.approx((1619800, 1925000), abs=3000)
    # One degree of latitude near a standard parallel.
    assert r.l1.y == pytest.approx(110_990, abs=60)


def test_equal_area(spark):
    """A small cell keeps its ellipsoidal area whatever its place."""
    e2 = 0.00669438002290
    for lon, lat in ((-120.0, 30.0), (-75.0, 45.0), (-96.0, 38.0)):
        d = 0.001
        pts = [(lon, lat), (lon + d, lat), (lon + d, lat + d), (lon, lat + d)]
        row = spark.range(1).select(*[F.expr(albers(f"{x!r}D", f"{y!r}D")).alias(f"p{i}") for i, (x, y) in enumerate(pts)]).first()
        xy = [(p.x, p.y) for p in row]
        got = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(xy, xy[1:] + xy[:1]))) / 2
        phi = np.radians(lat + d / 2)
        w = 1 - e2 * np.sin(phi) ** 2
        want = (6378137 * (1 - e2) / w**1.5 * np.radians(d)) * (6378137 / np.sqrt(w) * np.cos(phi) * np.radians(d))
        assert got == pytest.approx(want, rel=1e-6)


# --- Temporal ---


def test_vintages(spark):
    years = spark.createDataFrame([(2018,), (2022,), (1995,), (2035,)], "y int")
    config = temporal.default_vintages(spark)
    strict = temporal.vintage_for_year(years, config, "y", fallback=False).collect()
    assert [r.vintage for r in strict] == [2010, 2020, None, None]
    assert [r.vintage for r in temporal.vintage_for_year(years, config, "y").collect()] == [2010, 2020, 1990, 2030]


def test_seed_twice(spark):
    seed = temporal.default_vintages(spark)
    first = upsert.insert_if_absent(seed.limit(0), seed, ["decade"])
    assert first.count() == 4
    assert upsert.insert_if_absent(first, seed, ["decade"]).count() == 4


def test_plans_on_days(spark):
    windows = temporal.plan_windows(court_plans(spark), ["state_fips", "chamber"])
    days = [("01", "2023-06-07"), ("01", "2023-06-08"), ("01", "2030-01-01"), ("36", "2022-05-01"), ("36", "2022-04-27"), ("99", "2023-01-01"), ("01", "2021-01-01")]
    rows = spark.createDataFrame(days, "state_fips string, d string").withColumn("d", F.to_date("d"))
    got = {(r.state_fips, str(r.d)): r.plan_name for r in temporal.plan_on_date(rows, windows, "d", ["state_fips"], ["plan_name"]).collect()}
    assert got["01", "2023-06-07"] == "2021 Alabama Enacted Congressional Plan"
    assert got["01", "2023-06-08"] == "Allen v. Milligan Interim Plan"
    assert got["01", "2030-01-01"] == "Allen v. Milligan Final Plan"
    assert got["36", "2022-05-01"] is None and got["99", "2023-01-01"] is None and got["01", "2021-01-01"] is None
    assert got["36", "2022-04-27"] == "2022 New York Enacted Congressional Plan"


def test_nested_plan_windows(spark):
    """After a short plan inside a long one the long one is active again."""
    rows = [("a", "long", "2020-01-01", "2020-12-31"), ("a", "short", "2020-03-01", "2020-04-30"), ("a", "open", "2021-06-01", None)]
    plans = spark.createDataFrame(rows, "k string, name string, f string, t string").select(
        "k", "name", F.to_date("f").alias("effective_from"), F.to_date("t").alias("effective_to")
    )
    windows = temporal.plan_windows(plans, ["k"])
    days = spark.sql("SELECT 'a' AS k, explode(sequence(DATE'2019-12-30', DATE'2021-07-01')) AS d")
    got = {r.d: r.name for r in temporal.plan_on_date(days, windows, "d", ["k"], ["name"]).collect()}
    assert len(got) == days.count()
    D = dt.date
    for d, name in got.items():
        active = [(s, n) for n, s, e in (("long", D(2020, 1, 1), D(2020, 12, 31)), ("short", D(2020, 3, 1), D(2020, 4, 30)), ("open", D(2021, 6, 1), D(9999, 1, 1))) if s <= d <= e]
        assert name == (max(active)[1] if active else None)


def test_asof_against_pandas(spark):
    rng = np.random.default_rng(2)
    base = pd.Timestamp("2024-01-01")

    def make(n):
        key = np.where(rng.uniform(size=n) < 0.4, 0, rng.integers(0, 6, n))
        return pd.DataFrame({"id": range(n), "k": key, "ts": base + pd.to_timedelta(rng.integers(0, 400_000, n), unit="s")})

    left, right = make(300), make(200)
    right["v"] = right["id"]
    got = temporal.asof_join(
        spark.createDataFrame(left), spark.createDataFrame(right[["k", "ts", "v"]]), key="k", left_ts="ts", right_ts="ts", values=["v"], tie=["v"]
    ).toPandas()
    assert len(got) == len(left)
    for r in got.itertuples():
        hits = right[(right.k == r.k) & (right.ts <= r.ts)].sort_values(["ts", "v"])
        want = hits.v.iloc[-1] if len(hits) else None
        assert (want is None and pd.isna(r.v)) or r.v == want


def test_asof_spreads_one_key_and_keeps_rows_without_a_place(spark, monkeypatch):
    """Nearly all rows have one key and one month; they fill all ranges, and carry over them."""
    kept = {}
    monkeypatch.setattr(temporal, "spool", lambda df, label: kept.setdefault(label, spool(df, label)))
    rng = np.random.default_rng(6)
    base, day = pd.Timestamp("2024-03-01"), pd.Timestamp("2024-03-01").to_pydatetime()
    n = 6000

    def make(n, every):
        key = np.where(rng.uniform(size=n) < 0.95, 7, rng.integers(0, 4, n))
        # Many rows share a second, and the right side is thin, so most ranges hold none of it.
        ts = base + pd.to_timedelta(rng.integers(0, 2_500_000 // every, n) * every, unit="s")
        return pd.DataFrame({"id": range(n), "k": key.astype("int64"), "ts": ts})

    left, right = make(n, 50_000), make(12, 1)
    right["v"] = right["id"] % 5
    l_rows = spark.createDataFrame(left).union(spark.createDataFrame([(-1, None, day), (-2, 7, None), (-3, 7, day), (-3, 7, day)], "id long, k long, ts timestamp"))
    r_rows = spark.createDataFrame(right[["k", "ts", "v"]]).union(spark.createDataFrame([(None, day, 99), (7, None, 98)], "k long, ts timestamp, v long"))
    got = temporal.asof_join(l_rows, r_rows, key="k", left_ts="ts", right_ts="ts", values=["v"], tie=["v"]).toPandas()
    assert len(got) == n + 4
    frame = pd.concat([left, pd.DataFrame({"id": [-3, -3], "k": [7, 7], "ts": [base, base]})])
    want = pd.merge_asof(frame.sort_values("ts"), right[["k", "ts", "v"]].sort_values(["ts", "v"]), on="ts", by="k").set_index("id").v
    for r in got.itertuples():
        expected = want[r.id].iloc[0] if r.id == -3 else want.get(r.id) if r.id >= 0 else None
        assert pd.isna(r.v) if expected is None or pd.isna(expected) else r.v == expected
    per_range = kept["ranged"].filter("_key = 7").groupBy("_slice").count().toPandas()["count"]
    assert len(per_range) >= 6 and per_range.max() < 0.35 * n


# --- Merges, history, checks ---


def test_upsert_null_keys(spark):
    target = spark.createDataFrame([(1, None, "a"), (1, "p", "b"), (2, None, "c")], "id int, plan string, v string")
    source = spark.createDataFrame([(1, None, "A"), (3, None, "D")], "id int, plan string, v string")
    got = {(r.id, r.plan): r.v for r in upsert.merge_upsert(target, source, ["id", "plan"]).collect()}
    assert got == {(1, None): "A", (1, "p"): "b", (2, None): "c", (3, None): "D"}
    again = upsert.merge_upsert(upsert.merge_upsert(target, source, ["id", "plan"]), source, ["id", "plan"])
    assert again.count() == 4
    assert quality.duplicate_keys(target.union(target.limit(1)), ["id", "plan"]).collect()[0].n == 2


def test_upsert_latest_source_row(spark):
    target = spark.createDataFrame([(1, 0, "a")], "id int, at int, v string")
    source = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "id int, at int, v string")
    assert [tuple(r) for r in upsert.merge_upsert(target, source, ["id"], latest_by=["at"]).collect()] == [(1, 2, "y")]


def test_upsert_table_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 1)], "id int, part string, v int")
    upsert.upsert_table(spark, path, a, ["id", "part"], ["part"])
    before = sorted(p.name for p in (tmp_path / "t" / "part=y").iterdir())
    upsert.upsert_table(spark, path, spark.createDataFrame([(1, "x", 9), (3, "x", 3)], a.schema), ["id", "part"], ["part"])
    assert {tuple(r) for r in spark.read.parquet(path).select("id", "part", "v").collect()} == {(1, "x", 9), (2, "y", 1), (3, "x", 3)}
    assert sorted(p.name for p in (tmp_path / "t" / "part=y").iterdir()) == before


def test_upsert_keeps_codes_and_reduces_keys(spark, tmp_path):
    path, schema = str(tmp_path / "c"), "id int, st string, v int"
    for rows in ([(1, "01", 1), (2, "10", 1), (3, None, 1)], [(1, "01", 5), (1, "01", 7), (4, "02", 2)], [(3, None, 9)]):
        out = upsert.upsert_table(spark, path, spark.createDataFrame(rows, schema), ["id", "st"], ["st"], ["v"])
    assert {tuple(r) for r in out.select("id", "st", "v").collect()} == {(1, "01", 7), (2, "10", 1), (3, None, 9), (4, "02", 2)}


def test_null_weights_come_last(spark):
    df = spark.createDataFrame([("a", "t1", None), ("a", "t2", 0.9), ("b", "t3", None)], "s string, t string, w double")
    got = sorted(map(tuple, history.best_by_weight(df, "s", "t", "w").collect()))
    assert got == [("a", "t2", 0.9), ("b", "t3", None)]


def test_best_by_weight_ties(spark):
    df = spark.createDataFrame([("a", "t2", 1.0), ("a", "t1", 1.0), ("a", "t3", 0.5)], "s string, t string, w double")
    assert tuple(history.best_by_weight(df, "s", "t", "w").first()) == ("a", "t1", 1.0)


def test_rules_and_orphans(spark):
    df = spark.createDataFrame([(1, 1700, None), (2, 2020, 5), (3, None, 9)], "id int, vintage_year int, ref int")
    assert [tuple(r) for r in quality.violations(df, quality.RULES["dim_geography"], ["id"]).collect()] == [(1, "vintage_year")]
    parent = spark.createDataFrame([(5,)], "key int")
    assert [r.id for r in quality.orphans(df, parent, {"ref": "key"}).collect()] == [3]


def test_numbers_without_one_big_sort(spark):
    df = spark.range(500).selectExpr("(id * 37) % 500 AS v", "id % 3 AS g").repartition(7)
    got = numbering.number_rows(df, ["v"], "n").collect()
    assert all(r.n == r.v + 1 for r in got)
    grouped = numbering.number_rows(df, ["v"], "n", by=["g"], start=0).toPandas()
    for _, part in grouped.groupby("g"):
        assert list(part.sort_values("v").n) == list(range(len(part)))


def test_components(spark, monkeypatch):
    """Random graphs with a hub, with and without spreading of the hub's edges."""
    rng = np.random.default_rng(9)
    pairs = [(0, int(v)) for v in range(1, 60)] + [tuple(map(int, p)) for p in rng.integers(60, 300, (180, 2))]
    parent = list(range(320))

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in pairs:
        parent[find(a)] = find(b)
    nodes = spark.range(320).withColumnRenamed("id", "node")
    edges = spark.createDataFrame(pairs, "src long, dst long")
    for limit in (skew.HOT_ROWS, 5):
        monkeypatch.setattr(skew, "HOT_ROWS", limit)
        monkeypatch.setattr(components, "HOT_ROWS", limit)
        got = {r.node: r.component for r in connected_components(nodes, edges).collect()}
        assert len(got) == 320
        groups = {}
        for v, c in got.items():
            groups.setdefault(find(v), set()).add(c)
        assert all(len(g) == 1 for g in groups.values())
        assert len(set(got.values())) == len(groups)

import datetime as dt
import os
import struct

import pytest
from pyspark.sql import functions as F
from shapes import as_rings, box

from plumbline import session
from plumbline.functions import geometry as g
from plumbline.plans import assignment, clustering, enrichment, geocoding, serving, warehouse
from plumbline.operators.temporal import default_vintages
from plumbline.queries.loads import _shape_bytes
from plumbline.sources import geojson, jdbc, lake, plans, shapefile, tables, updates, voters
from plumbline.streaming.placement import place_stream, write_stream

SHAPES = f"geoid string, name string, summary_level string, vintage_year int, rings {g.RINGS}"


# --- Sources ---


def test_coerce_points(spark):
    df = spark.createDataFrame([("1.0", "2.0"), ("invalid", "3.0"), ("", ""), ("181", "0"), ("-180", "90"), ("NaN", "1"), ("1d", "1")], "lon string, lat string")
    assert [(r.x, r.y) for r in voters.coerce_points(df, "lon", "lat").collect()] == [(1.0, 2.0), (-180.0, 90.0)]
    assert tuple(voters.coordinate_report(df, "lon", "lat").first()) == (7, 2, 4, 1)
    with pytest.raises(ValueError, match="nope"):
        voters.coerce_points(df, "nope", "lat")


def test_replace_keeps_the_table_when_the_write_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.replace_table(spark.range(3), path)
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception):
        lake.replace_table(bad, path)
    assert spark.read.parquet(path).count() == 3
    lake.replace_table(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_registry(spark, tmp_path):
    root = str(tmp_path)
    paths = lake.create_all_tables(spark, root)
    assert set(paths) == set(lake.SCHEMAS) == set(lake.PARTITIONS)
    rows = spark.createDataFrame([(1, "01", 1.5)], "id long, state_abbreviation string, longitude double").withColumn("ingested_at", F.current_timestamp())
    lake.write_table(rows, root, "bronze.addresses")
    lake.create_table(spark, root, "bronze.addresses")
    back = lake.read_table(spark, root, "bronze.addresses")
    assert back.count() == 1 and back.first().state_abbreviation == "01"
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in lake.table_schema("bronze.addresses")]
    lake.create_table(spark, root, "bronze.addresses", overwrite=True)
    assert lake.read_table(spark, root, "bronze.addresses").count() == 0
    with pytest.raises(ValueError):
        lake.create_table(spark, root, "bronze.nothing")


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:postgresql://h/d", "t", partition_column="id", lower=1, upper=9, partitions=4)
    assert o["fetchsize"] == "100000" and o["numPartitions"] == "4" and o["lowerBound"] == "1"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("u", "t", partition_column="id")


def test_shapefile_folder(spark, tmp_path):
    import pandas as pd

    shapes = pd.DataFrame({"geoid": ["01", "02"], "name": ["A", "B"], "rings": [as_rings(box(0, 0, 2, 2)), as_rings(box(5, 5, 6, 9))]})
    for path, content in _shape_bytes(shapes).itertuples(index=False):
        (tmp_path / f"tl_2020{path.replace('/', '_')}").write_bytes(content)
    (tmp_path / "readme.txt").write_text("no")
    got = {r.geoid: r for r in shapefile.read_shapefiles(spark, str(tmp_path), ["GEOID", "NAME"]).withColumn("a", F.expr(g.area("rings"))).collect()}
    assert {k: (r.name, r.a) for k, r in got.items()} == {"01": ("A", 4.0), "02": ("B", 4.0)}
    table = str(tmp_path / "table")
    shapefile.load_shapefiles(spark, str(tmp_path), table, ["GEOID"])
    assert {(r.source, r.geoid) for r in spark.read.parquet(table).collect()} == {("tl_2020_01", "01"), ("tl_2020_02", "02")}
    # A point record and a null record.
    point = struct.pack(">2i", 1, 10) + struct.pack("<i2d", 1, 3.0, 4.0)
    empty = struct.pack(">2i", 2, 2) + struct.pack("<i", 0)
    records = list(shapefile.read_records(bytes(100) + point + empty))
    assert records[0][0].tolist() == [[3.0, 4.0]] and records[1] is None


def test_small_shapefiles_share_batches():
    import pandas as pd

    shapes = pd.DataFrame([(f"{i:04d}", f"County {i}", [[{"x": x, "y": y} for x, y in box(i, 0, i + 1, 2)]]) for i in range(1500)], columns=["geoid", "name", "rings"])
    files = _shape_bytes(shapes)["content"].tolist()
    pairs = pd.DataFrame({"stem": shapes["geoid"], "shp": files[::2], "dbf": files[1::2]})
    got = list(shapefile.decode(iter([pairs[:700], pairs[700:]])))
    assert [len(f) for f in got] == [1000, 500]
    rows = pd.concat(got)
    assert rows["stem"].tolist() == [dict(a)["GEOID"] for a in rows["attributes"]] == shapes["geoid"].tolist()
    assert set(rows["record"]) == {0} and rows["rings"].iloc[7][0][0]["x"] in (7.0, 8.0)


def test_plan_file(spark, tmp_path):
    (tmp_path / "plans.json").write_text(
        '[{"model": "x", "fields": {"state_fips": "01", "chamber": "congress", "cycle_year": 2020, "effective_from": "2022-01-01", "effective_to": null}}]'
    )
    row = plans.read_plans(spark, str(tmp_path / "plans.json")).first()
    assert (row.state_fips, row.cycle_year, row.effective_from, row.effective_to) == ("01", 2020, dt.date(2022, 1, 1), None)


def test_updates(spark):
    listing = spark.createDataFrame([("geo/tiger/TIGER2019",), ("TIGER2020PL",), ("geo/OLD2021",)], "entry string")
    years = updates.tiger_vintages(listing)
    assert sorted(r.vintage for r in years.collect()) == [2019, 2020]
    none = spark.createDataFrame([], "vintage int")
    assert tuple(updates.new_vintage(years, none).first()) == (2020, None, True)
    assert tuple(updates.new_vintage(years, spark.createDataFrame([(2020,)], "vintage int")).first()) == (2020, 2020, False)
    assert updates.new_vintage(none, none).first().has_update is False


def test_table_names(spark):
    for name in ("tl_2020_46003_roads", "tl_2020_46001_roads", "tl_2019_46001_roads", "tl_2020_45001_roads", "tl_2020_46001_rails"):
        spark.range(1).selectExpr("'1' AS linearid", "'x' AS fullname").createOrReplaceTempView(name)
    names = tables.matching_tables(spark, "roads", "2020", "46")
    assert sorted(names) == ["tl_2020_46001_roads", "tl_2020_46003_roads"]
    assert tables.union_tables(spark, names, {"linearid": "bigint", "fullname": "string"}).count() == 2
    assert tables.matching_tables(spark, "roads", "2020", "46", among=["tl_2020_46001_roads"]) == ["tl_2020_46001_roads"]
    for table in spark.catalog.listTables():
        if table.name.startswith("tl_"):
            spark.catalog.dropTempView(table.name)


def test_geojson(spark):
    df = spark.createDataFrame([("1", as_rings(box(0, 0, 4, 4), box(1, 1, 2, 2)[::-1], box(9, 9, 10, 10))), ("2", None)], f"geoid string, rings {g.RINGS}")
    import json

    text = geojson.collection(geojson.features(df, ["geoid"]), ["geoid"]).first().collection
    out = json.loads(text)
    by_id = {f["properties"]["geoid"]: f["geometry"] for f in out["features"]}
    assert [len(p) for p in by_id["1"]["coordinates"]] == [2, 1] and by_id["2"] is None


def test_collection_order_and_bound(spark):
    import json

    page = spark.createDataFrame([(n, f'{{"id":{n % 3},"n":{n}}}') for n in (3, 1, 2)], "rank int, feature string")
    assert [f["n"] for f in json.loads(geojson.collection(page, ["rank"]).first().collection)["features"]] == [1, 2, 3]
    many = spark.range(501).selectExpr("id", "'{}' AS feature")
    with pytest.raises(Exception, match="at most 500"):
        geojson.collection(many, ["id"]).first()


def test_work_dir_setting():
    class Stub:
        class sparkContext:
            applicationId, master = "app-1", "spark://host:7077"

        def __init__(self, **conf):
            self.conf = conf

    assert session.work_dir(Stub(**{"spark.checkpoint.dir": "hdfs://shared/place/"})) == "hdfs://shared/place/plumbline/app-1"
    with pytest.raises(RuntimeError):
        session.work_dir(Stub())


def test_checkpoint_setting_reaches_the_session():
    """A separate process, since the setting is fixed when a session starts."""
    import subprocess
    import sys
    import tempfile

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with tempfile.TemporaryDirectory() as shared:
        code = (
            f"import sys; sys.path.insert(0, {root!r})\n"
            "from plumbline.session import get_session, spool\n"
            f"s = get_session('t', 'local[1]', spark__ui__enabled='false', spark__checkpoint__dir={shared!r})\n"
            "print(spool(s.range(3)).inputFiles()[0])\n"
        )
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout
        assert shared in out


# --- Warehouse ---


def test_load_warehouse_twice(spark, tmp_path):
    levels = {
        "state": spark.createDataFrame([("06", "California")], "geoid string, name string"),
        "county": spark.createDataFrame([("06037", "Los Angeles", 5)], "geoid string, name string, area_land long"),
    }
    acs = spark.createDataFrame(
        [("0500000US|06037", "10000", "500", "-"), ("06", "1", None, "2"), ("99", "1", "1", "1"), ("", "1", "1", "1")],
        "GEO_ID string, B01001_001E string, B01001_001M string, B19013_001E string",
    )
    dec = spark.createDataFrame([("06037", "9829544", "x")], "geoid string, P1_001N string, P1_003N string")
    for _ in range(2):
        out = warehouse.load_warehouse(
            spark, str(tmp_path), levels=levels, acs_rows=acs, decennial_rows=dec, boundary_year=2020, acs_year=2022, years=(2020, 2020),
            plans=spark.createDataFrame([(2020,), (2010,)], "cycle_year int"),
        )
    dims = {(r.geoid, r.vintage_year): r for r in out["dim_geography"].collect()}
    assert len(dims) == 4 and dims["06037", 2020].parent_geoid == "06" and dims["06", 2020].parent_key is None
    assert dims["06037", 2020].effective_to == dt.date(2021, 12, 31) and dims["06037", 2022].is_current
    facts = {(r.geoid, r.variable_code): r for r in out["fact_acs_estimate"].collect()}
    assert set(facts) == {("06037", "B01001_001E"), ("06", "B01001_001E"), ("06", "B19013_001E")}
    assert facts["06037", "B01001_001E"].reliability == "high" and facts["06", "B01001_001E"].reliability == "suppressed"
    assert [(r.variable_code, r["count"]) for r in out["fact_decennial_count"].collect()] == [("P1_001N", 9829544)]
    assert out["dim_time"].count() == 366 and out["dim_redistricting_cycle"].count() == 2
    view = warehouse.fact_view(out["fact_acs_estimate"], out["dim_geography"], out["dim_census_variable"], out["dim_survey"])
    assert {(r.name, r.survey_type) for r in view.collect()} == {("California", "acs5"), ("Los Angeles", "acs5")}
    with pytest.raises(ValueError):
        warehouse.geography_dimension({"river": levels["state"]}, 2020)


def test_variables(spark):
    assert warehouse.resolve_variables(["income", "B99_001E"]) == ["B19013_001E", "B99_001E"]
    row = warehouse.variable_dimension(spark, ["B01001_001E"], "acs5").first()
    assert row.table_id == "B01001" and row.is_estimate and not row.is_moe


# --- Assignment, enrichment, lookups ---


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [
        ("01", "One", "state", 2020, as_rings(box(0, 0, 10, 10))),
        ("01001", "C", "county", 2020, as_rings(box(0, 0, 5, 10))),
        ("01001000100", "T", "tract", 2020, as_rings(box(0, 0, 5, 5))),
        ("01009000100", "T2", "tract", 2020, as_rings(box(5, 0, 10, 5))),
        ("010010001001", "G", "block_group", 2020, as_rings(box(0, 0, 2, 2))),
        ("V1", "V", "vtd", 2020, as_rings(box(0, 0, 10, 10))),
        ("0101", "D", "cd", 2020, as_rings(box(0, 0, 10, 10))),
        ("02", "Old", "state", 2010, as_rings(box(0, 0, 50, 50))),
    ]
    return spark.createDataFrame(rows, SHAPES)


def test_gates(spark, shapes):
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 7.0, 1.0), (3, 20.0, 20.0), (4, 4.0, 8.0), (5, None, None)], "id long, x double, y double")
    out = {r.id: r for r in assignment.assign_boundaries(points, shapes, vintage_year=2020).collect()}
    assert out[1].block_group_geoid == "010010001001" and out[1].vtd_geoid == "V1" and out[1].census_year == 2020
    # No county there, so no tract, block group or VTD; districts do not need one.
    assert (out[2].state_geoid, out[2].county_geoid, out[2].tract_geoid, out[2].vtd_geoid, out[2].cd_geoid) == ("01", None, None, None, "0101")
    assert not out[3].assigned and out[3].state_geoid is None and out[3].census_year is None and not out[5].assigned
    # A VTD needs a county but no tract.
    assert (out[4].tract_geoid, out[4].vtd_geoid) == (None, "V1")
    periods = assignment.boundary_periods(assignment.assign_boundaries(points, shapes, vintage_year=2020), 2020)
    assert periods.count() == 3


def test_stored_index_serves_as_boundaries(spark, shapes, tmp_path):
    from plumbline.sources.boundaries import read_cell_index, write_cell_index

    points = spark.range(60).selectExpr("id", "id / 5.0D AS x", "id % 11 + 0.5D AS y")
    write_cell_index(shapes, str(tmp_path / "index"))
    index = read_cell_index(spark, str(tmp_path / "index"), 2020)
    columns = ["id", *assignment.LEVEL_COLUMNS.values()]
    a = assignment.assign_boundaries(points, index, vintage_year=2020).select(*columns).collect()
    b = assignment.assign_boundaries(points, shapes, vintage_year=2020).select(*columns).collect()
    assert sorted(a, key=str) == sorted(b, key=str) and any(r.tract_geoid for r in a)


def test_plan_without_a_district_keeps_its_name(spark, shapes):
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 9.0, 9.0)], "id long, x double, y double")
    plan = spark.createDataFrame([("P", "01", "congress", "2022-01-01", None)], "plan_id string, state_fips string, chamber string, f string, t string").select(
        "plan_id", "state_fips", "chamber", F.to_date("f").alias("effective_from"), F.to_date("t").alias("effective_to")
    )
    districts = spark.createDataFrame([("P", "", "7", as_rings(box(0, 0, 5, 5)))], f"plan_id string, geoid string, district_number string, rings {g.RINGS}")

    def run(date):
        out = assignment.assign_boundaries(points, shapes, vintage_year=2020, plans=plan, plan_districts=districts, context_date=date)
        return {r.id: (r.cd_geoid, r.plan_id, r.assignment_method) for r in out.collect()}

    assert run("2023-01-01") == {1: ("7", "P", "PLAN_SPATIAL_JOIN"), 2: ("0101", "P", "SPATIAL_JOIN")}
    assert run("2021-01-01") == {1: ("0101", None, "SPATIAL_JOIN"), 2: ("0101", None, "SPATIAL_JOIN")}


def test_crosswalk_needs_both_vintages(spark):
    periods = spark.createDataFrame([(1, 2010, "01", "01001", "T1"), (2, 2010, "01", "01001", "T1"), (2, 2020, "01", "01001", "T9")], "address_id long, vintage int, state_geoid string, county_geoid string, tract_geoid string")
    walk = spark.createDataFrame([(2010, 2020, "T1", "02003000100", 0.4), (2010, 2020, "T1", "X", 0.3)], "source_vintage_year int, target_vintage_year int, source_geoid string, target_geoid string, weight double")
    vintages = default_vintages(spark)
    got = enrichment.apply_crosswalk(periods, walk, vintages, 2010, 2020).collect()
    assert [(r.address_id, r.county_geoid, r.tract_geoid, r.assignment_method) for r in got] == [(1, "02003", "02003000100", "FIPS_LOOKUP")]
    assert enrichment.apply_crosswalk(periods, walk, vintages.filter("decade < 2020"), 2010, 2020).count() == 0


def test_repeated_geocodes_give_one_address(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    schema = "id long, matched boolean, lat double, lon double, match_type string, state_fips string, county_fips string, tract string, block string, result_order int"
    census = spark.createDataFrame([(1, True, 3.0, 5.0, "Exact", "11", "001", "006202", "1031", 1), (1, True, 2.0, 5.0, "Later", "11", "001", "006202", "1031", 2)], schema)
    second = spark.createDataFrame([(2, 9.0, 9.0), (2, 8.0, 8.0), (2, None, 8.0)], "id long, lat double, lon double")
    got = sorted((r.id, r.latitude, r.geocode_quality) for r in geocoding.match_geocodes(rows, census, second).collect())
    assert got == [(1, 2.0, "Later"), (2, 9.0, "Approximate")]


def test_no_known_code_gives_no_rows(spark):
    from plumbline.operators.pivot import to_long

    out = to_long(spark.createDataFrame([("1", "5")], "geoid string, OTHER string"), ["geoid"], ["B01001_001E"])
    assert out.columns == ["geoid", "variable_code", "value", "moe_value"] and out.count() == 0


def test_medians_are_not_summed(spark):
    variables = warehouse.variable_dimension(spark, ["B01002_001E", "B01001_001E", "ZZ_1"], "acs5", {"ZZ": "extensive"})
    assert {r.variable_code: r.variable_type for r in variables.collect()} == {"B01002_001E": "intensive", "B01001_001E": "extensive", "ZZ_1": "extensive"}
    facts = spark.createDataFrame([("06037000100", c, 40.0) for c in ("B01002_001E", "B01001_001E", "YY_1")], "geoid string, variable_code string, estimate double")
    assert {r.variable_code for r in warehouse.roll_up(facts, variables).collect()} == {"B01001_001E"}


def test_page_limit(spark):
    with pytest.raises(ValueError, match="at most"):
        serving.page(spark.range(3), ["id"], 1, 10**6)


def test_geocode_modes(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    census = spark.createDataFrame([(1, True, 0.0, 5.0, "Exact", "11", "001", "006202", "1031")], "id long, matched boolean, lat double, lon double, match_type string, state_fips string, county_fips string, tract string, block string")
    second = spark.createDataFrame([(1, 9.0, 9.0), (2, 8.0, 8.0)], "id long, lat double, lon double")

    def run(mode):
        return {r.id: (r.geocode_source, r.geocode_quality, r.has_position) for r in geocoding.match_geocodes(rows, census, second, mode).collect()}

    assert run("dual") == {1: ("census", "Exact", False), 2: ("nominatim", "Approximate", True), 3: (None, None, False)}
    assert run("census-only") == {1: ("census", "Exact", False), 2: (None, None, False), 3: (None, None, False)}
    assert run("fallback-only") == {1: ("nominatim", "Approximate", True), 2: ("nominatim", "Approximate", True), 3: (None, None, False)}


def test_detail_and_order(spark, shapes):
    assert serving.boundary_detail(shapes, "01").first().name == "One"
    assert "rings" in serving.boundary_detail(shapes, "01").columns
    assert serving.ordered(shapes, "geography", "-name").first().name == "V"
    assert serving.ordered(shapes, "geography", "rings").first().geoid == "01"
    assert serving.page(shapes, ["geoid"], 2, 3).count() == 3


def test_clustering_run(spark):
    """Three tight groups near Richmond; one voter carries the label of another state."""
    rows, lon, lat = [], -77.45, 37.55
    for c in range(3):
        rows += [(c * 10 + i, lon + c * 0.01 + i * 0.00001, lat, "VA", "African-American ", 60, "4", "s", "h", f"p{c % 2}") for i in range(6)]
    rows += [(90, lon, lat, "NC", "African-American", 60, "4", "s", "h", "p0"), (91, lon, lat, "VA", "Other", 60, "4", "s", "h", "p0"), (92, lon + 0.2, lat, "VA", "African-American", 60, "4", "s", "h", "p0")]
    voters_df = spark.createDataFrame(rows, "vanid long, longitude double, latitude double, state string, racename string, age int, cd string, sd string, hd string, precinctname string")
    states = spark.createDataFrame([("VA", as_rings(box(-80, 36, -75, 39))), ("NC", as_rings(box(-80, 33, -75, 36)))], f"stusps string, rings {g.RINGS}")
    out = {r.vanid: r for r in clustering.cluster_voters(voters_df, states, groupings=["cluster_id_within_cd", "cluster_id_within_cd_and_precinct"]).collect()}
    assert 90 not in out and len(out) == 20
    assert [out[k].cluster_id for k in (0, 10, 20, 92)] == [0, 1, 2, -1] and out[91].cluster_id is None
    assert [out[k].cluster_id_within_cd for k in (0, 10, 20, 91, 92)] == ["4-p0-0", "4-p1-1", "4-p0-2", "-1", "-1"]
    assert [out[k].cluster_id_within_cd_and_precinct for k in (0, 10, 20)] == ["4-p0-0", "4-p1-0", "4-p0-1"]


def test_stream_equals_batch(spark, shapes, tmp_path):
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    points = spark.range(40).selectExpr("id", "id / 3.0D AS x", "id / 5.0D AS y")
    points.repartition(4).write.parquet(source)
    from plumbline.operators.pip import point_in_polygon

    for _ in range(2):
        stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(source)
        write_stream(place_stream(stream, shapes).select("id", "geoid"), sink, marks).awaitTermination()
    got = sorted((r.id, r.geoid) for r in spark.read.parquet(sink).collect())
    assert got == sorted((r.id, r.geoid) for r in point_in_polygon(points, shapes).select("id", "geoid").collect())


def test_roll_up_along_parents(spark):
    from plumbline.plans import warehouse

    tree = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", None), ("x", "d"), ("lone", None)]
    geographies = spark.createDataFrame(tree, "geography_key string, parent_key string")
    pairs = {tuple(r) for r in warehouse.ancestors(geographies).collect()}
    chain = "abcde"
    want = {(chain[i], chain[j]) for i in range(5) for j in range(i, 5)} | {("x", "x"), ("x", "d"), ("x", "e"), ("lone", "lone")}
    assert pairs == want
    facts = spark.createDataFrame(
        [("a", "pop", 10.0), ("x", "pop", 30.0), ("lone", "pop", None), ("a", "rate", 1.0), ("x", "rate", 5.0), ("a", "age", 40.0), ("x", "none", 1.0)],
        "geography_key string, variable_code string, estimate double",
    )
    variables = spark.createDataFrame(
        [("pop", "extensive", None), ("rate", "intensive", "pop"), ("age", "intensive", None)], "variable_code string, variable_type string, weight_code string"
    )
    got = {(r[0], r[1]): r[2] for r in warehouse.roll_up_parents(facts, geographies, variables).collect()}
    assert got == {
        **{(k, "pop"): 10.0 for k in "abc"}, **{(k, "rate"): 1.0 for k in "abc"}, ("x", "pop"): 30.0, ("x", "rate"): 5.0,
        ("d", "pop"): 40.0, ("e", "pop"): 40.0, ("d", "rate"): 4.0, ("e", "rate"): 4.0, ("lone", "pop"): None,
    }
    circle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "geography_key string, parent_key string")
    with pytest.raises(ValueError, match="circle"):
        warehouse.ancestors(circle)


def test_placement_of_a_stream_is_spread(spark, tmp_path, monkeypatch):
    """The small input comes as files for every core, and each micro-batch compares plain columns of a written index."""
    from plumbline.queries import spatial

    plans = []

    def kept(stream, boundaries):
        out = place_stream(stream, boundaries)
        plans.append((out._jdf.queryExecution().analyzed().toString(), len(list((tmp_path / "source").glob("*.parquet")))))
        return out

    spark.createDataFrame([(k, f"Supplier#{k}", k % 25) for k in range(1, 60)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    spark.range(1, 500).selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey", "'M' AS c_mktsegment").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(spatial, "new_path", lambda s, name: str(tmp_path / name))
    monkeypatch.setattr(spatial, "place_stream", kept)
    got = sorted(spatial.stream_point_placement(spark, str(tmp_path)).collect())
    assert got and got == sorted(spatial.counties_of_address(spark, str(tmp_path)).collect())
    text, files = plans[0]
    assert files >= spark.sparkContext.defaultParallelism and "lambda" not in text and "_flip" in text

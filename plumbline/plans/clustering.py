"""Voter clustering: label check, density clusters by geography, hulls, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import geometry as g
from plumbline.functions import measures as m
from plumbline.functions.projection import lambert
from plumbline.operators.dbscan import dbscan
from plumbline.operators.hull import convex_hulls
from plumbline.operators.numbering import number_rows
from plumbline.operators.pip import label_matches_space
from plumbline.operators.upsert import update_from
from plumbline.session import spool

# Eps in metres and the least number of neighbours.
EPS, MIN_POINTS = 20.0, 5

# The filter of the voters that are clustered.
VOTER_FILTER = "trim(racename) = 'African-American' AND age > 50"

# Label column -> (partition columns, label prefix columns).
GROUPINGS = {
    "cluster_id_within_cd": (("cd",), ("cd", "precinctname")),
    "cluster_id_within_sd": (("sd",), ("sd", "precinctname")),
    "cluster_id_within_hd": (("hd",), ("hd", "precinctname")),
    "cluster_id_within_cd_and_precinct": (("cd", "precinctname"), ("cd", "precinctname")),
    "cluster_id_within_sd_and_precinct": (("sd", "precinctname"), ("sd", "precinctname")),
    "cluster_id_within_hd_and_precinct": (("hd", "precinctname"), ("hd", "precinctname")),
}


def add_points(voters: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Adds `point` in degrees and `x, y` in the projected metres."""
    metres = F.expr(lambert(f"CAST({lon} AS DOUBLE)", f"CAST({lat} AS DOUBLE)"))
    return (
        voters.withColumn("point", F.expr(g.point(lon, lat)))
        .withColumn("_m", metres)
        .withColumns({"x": F.col("_m.x"), "y": F.col("_m.y")})
        .drop("_m")
    )


def check_labels(voters: DataFrame, boundaries: DataFrame, *, label: str, name: str, flag: str, id_col: str = "vanid") -> DataFrame:
    """Adds `flag`: whether the boundary named by the voter's label contains the voter (degrees)."""
    keyed = voters.select(id_col, label, F.col("point.x").alias("x"), F.col("point.y").alias("y"))
    flags = label_matches_space(keyed, boundaries, label=label, name=name, id_col=id_col, flag=flag)
    return voters.join(flags.select(id_col, flag), id_col)


def statewide_clusters(voters: DataFrame, *, where: str = VOTER_FILTER, eps: float = EPS, min_points: int = MIN_POINTS, id_col: str = "vanid") -> DataFrame:
    """Adds `cluster_id`: the cluster number, -1 for noise, null outside the filter."""
    found = dbscan(voters.filter(where).select(id_col, "x", "y"), id_col=id_col, eps=eps, min_points=min_points)
    found = found.select(id_col, F.coalesce("cluster", F.lit(-1)).alias("cluster_id"))
    return update_from(voters, found, id_col, {"cluster_id": None})


def grouped_clusters(
    voters: DataFrame, column: str, *, where: str = VOTER_FILTER, eps: float = EPS, min_points: int = MIN_POINTS, id_col: str = "vanid"
) -> DataFrame:
    """Adds one of the `GROUPINGS` labels: `geography-precinct-number`, '-1' for noise and outside the filter."""
    parts, prefix = GROUPINGS[column]
    chosen = voters.filter(where).select(id_col, "x", "y", *dict.fromkeys([*parts, *prefix]))
    found = dbscan(chosen, id_col=id_col, eps=eps, min_points=min_points, partition_by=parts)
    found = found.select(id_col, m.cluster_label("cluster", *prefix).alias(column))
    return update_from(voters, found, id_col, {column: "-1"})


def cluster_hulls(voters: DataFrame, column: str) -> DataFrame:
    """One hull per cluster label with a running `gid`, noise left out."""
    members = voters.filter(F.col(column) != "-1")
    return number_rows(convex_hulls(members, [column]), [column], "gid")


def label_match_counts(voters: DataFrame, flag: str = "state_label_spatial_matches") -> DataFrame:
    return voters.groupBy(flag).agg(F.count("*").alias("total_voters"))


def label_match_by_race(voters: DataFrame, flag: str = "state_label_spatial_matches", race: str = "racename") -> DataFrame:
    return voters.groupBy(race).agg(
        F.count_if(F.col(flag)).alias("state_label_matches"),
        F.count_if(~F.col(flag)).alias("state_label_does_not_match"),
    )


def cluster_sizes(voters: DataFrame, column: str) -> DataFrame:
    sizes = voters.filter(F.col(column) != "-1").groupBy(column).agg(F.count("*").alias("total_voters"))
    return sizes.orderBy(F.desc("total_voters"), column)


def cluster_voters(voters: DataFrame, states: DataFrame, *, state_name: str = "stusps", groupings: list[str] | None = None) -> DataFrame:
    """The whole run: points, state check, removal of mismatches, all cluster columns."""
    rows = check_labels(
        add_points(voters), states, label="state", name=state_name, flag="state_label_spatial_matches"
    )
    rows = spool(statewide_clusters(rows.filter("state_label_spatial_matches")), "clustered")
    for column in groupings or list(GROUPINGS):
        rows = spool(grouped_clusters(rows, column), "clustered")
    return rows

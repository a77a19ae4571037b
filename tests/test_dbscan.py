import numpy as np
import pandas as pd
import pytest

from plumbline.operators import dbscan as module
from plumbline.operators.dbscan import dbscan


def brute(pdf, eps, min_points):
    """Reference clustering by all pairs, numbered by the smallest core id."""
    xy = pdf[["x", "y"]].to_numpy()
    ids = pdf["id"].to_numpy()
    near = ((xy[:, None, :] - xy[None, :, :]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_points
    comp = np.where(core, ids, np.iinfo(np.int64).max)
    while True:
        new = comp.copy()
        for i in np.flatnonzero(core):
            new[i] = comp[near[i] & core].min()
        if (new == comp).all():
            break
        comp = new
    firsts = {c: k for k, c in enumerate(sorted(set(comp[core])))}
    out = {}
    for i in range(len(ids)):
        if core[i]:
            out[ids[i]] = firsts[comp[i]]
        else:
            c = comp[near[i] & core]
            out[ids[i]] = firsts[c.min()] if len(c) else None
    return out


def check(spark, pdf, eps, min_points, partition_by=()):
    df = spark.createDataFrame(pdf)
    got = dbscan(df, id_col="id", eps=eps, min_points=min_points, partition_by=partition_by)
    got = {r["id"]: r["cluster"] for r in got.collect()}
    want = {}
    for _, group in pdf.groupby(list(partition_by)) if partition_by else [(None, pdf)]:
        want.update(brute(group.reset_index(drop=True), eps, min_points))
    assert got == want


def sample(seed, n, spread, extra=()):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": rng.permutation(n), "x": rng.uniform(-spread, spread, n), "y": rng.uniform(-spread, spread, n)})
    pdf["g"] = rng.integers(0, 3, n)
    return pdf


@pytest.mark.parametrize("seed,spread,min_points", [(1, 60, 5), (2, 120, 4), (3, 30, 8)])
def test_matches_all_pairs(spark, seed, spread, min_points):
    check(spark, sample(seed, 300, spread), 8.0, min_points)


def test_partitioned(spark):
    check(spark, sample(4, 300, 60), 12.0, 4, ("g",))


def test_crowded_cells_are_split(spark, monkeypatch):
    # Low limits force the salted joins and the box refinement.
    import plumbline.operators.skew as skew

    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    monkeypatch.setattr(module, "_PAIR_LIMIT", 6)
    pdf = sample(5, 400, 40)
    pdf.loc[:130, ["x", "y"]] = [1.0, 1.0]
    pdf.loc[131:200, "x"] = 9.0 + pdf.loc[131:200, "x"] / 1000
    pdf.loc[131:200, "y"] = 1.0 + pdf.loc[131:200, "y"] / 1000
    check(spark, pdf, 8.0, 5)


def test_exact_distance_counts(spark):
    pdf = pd.DataFrame({"id": [1, 2, 3, 4], "x": [0.0, 20.0, 40.0, 61.0], "y": [0.0] * 4})
    check(spark, pdf, 20.0, 3)


def test_no_cluster_at_all(spark):
    pdf = pd.DataFrame({"id": [1, 2], "x": [0.0, 500.0], "y": [0.0, 0.0]})
    check(spark, pdf, 20.0, 5)


def test_points_without_a_place_are_noise(spark):
    rows = [(i, 0.5 * i, 0.0) for i in range(5)] + [(8, None, 0.0), (9, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    got = {r.id: r.cluster for r in dbscan(df, id_col="id", eps=20.0, min_points=5).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 8: None, 9: None}

"""Convex hulls and enclosing circles per group.

Hulls merge: the hull of a union is the hull of the parts' hulls. Each task
first reduces its own rows, then a bounded number of parts per group, then the
group, so no group arrives anywhere in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import geometry as g

# Groups a task holds before it hands on what it has.
_MAX_OPEN_GROUPS = 20_000


def hull_vertices(xy: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise from the lowest x, without collinear points."""
    pts = np.unique(xy, axis=0)
    if len(pts) < 3:
        return pts

    def chain(rows):
        out: list = []
        for p in rows:
            while len(out) > 1 and (
                (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0
            ):
                out.pop()
            out.append(p)
        return out

    return np.array(chain(pts)[:-1] + chain(pts[::-1])[:-1])


def convex_hulls(points: DataFrame, by: list[str], *, x: str = "x", y: str = "y", parts: int = 64) -> DataFrame:
    """`(by..., rings)`: the hull of each group as one closed ring.

    A group of one or two distinct points gives a ring of those points.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.select(*by).schema)
    rows = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")
    )

    def reduce_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        rows_kept = 0

        def reduced(frames):
            pdf = pd.concat(frames, ignore_index=True)
            out = []
            for key, part in pdf.groupby(by, dropna=False, sort=False):
                xy = hull_vertices(part[["_x", "_y"]].to_numpy())
                key = key if isinstance(key, tuple) else (key,)
                frame = pd.DataFrame(xy, columns=["_x", "_y"])
                for i, name in enumerate(by):
                    frame.insert(i, name, [part[name].iloc[0]] * len(frame))
                out.append(frame)
            return pd.concat(out, ignore_index=True)

        for batch in batches:
            if not len(batch):
                continue
            kept.append(batch)
            rows_kept += len(batch)
            if rows_kept > 5 * _MAX_OPEN_GROUPS:
                merged = reduced(kept)
                if len(merged) > 2 * _MAX_OPEN_GROUPS:
                    yield merged
                    kept, rows_kept = [], 0
                else:
                    kept, rows_kept = [merged], len(merged)
        if kept:
            yield reduced(kept)

    partial = rows.mapInPandas(reduce_task, f"{fields}, _x double, _y double")
    partial = partial.withColumn("_salt", F.pmod(F.xxhash64("_x", "_y"), F.lit(parts)).cast("int"))

    def reduce_part(pdf: pd.DataFrame) -> pd.DataFrame:
        frame = pd.DataFrame(hull_vertices(pdf[["_x", "_y"]].to_numpy()), columns=["_x", "_y"])
        for i, name in enumerate(by):
            frame.insert(i, name, [pdf[name].iloc[0]] * len(frame))
        return frame

    def close(pdf: pd.DataFrame) -> pd.DataFrame:
        xy = hull_vertices(pdf[["_x", "_y"]].to_numpy())
        ring = [{"x": float(a), "y": float(b)} for a, b in xy]
        row = {name: [pdf[name].iloc[0]] for name in by}
        row["rings"] = [[[*ring, ring[0]]]]
        return pd.DataFrame(row)

    merged = partial.groupBy(*by, "_salt").applyInPandas(reduce_part, f"{fields}, _x double, _y double")
    return merged.groupBy(*by).applyInPandas(close, f"{fields}, rings {g.RINGS}")


def enclosing_circle(xy: np.ndarray) -> tuple[float, float, float]:
    """Smallest circle (x, y, radius) around hull vertices, found by growing a support set."""
    pts = hull_vertices(xy)

    def of_two(a, b):
        c = (a + b) / 2
        return c[0], c[1], float(np.hypot(*(a - c)))

    def of_three(a, b, c):
        d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
        if d == 0:
            return max((of_two(p, q) for p, q in ((a, b), (a, c), (b, c))), key=lambda k: k[2])
        sa, sb, sc = (float(p @ p) for p in (a, b, c))
        ux = (sa * (b[1] - c[1]) + sb * (c[1] - a[1]) + sc * (a[1] - b[1])) / d
        uy = (sa * (c[0] - b[0]) + sb * (a[0] - c[0]) + sc * (b[0] - a[0])) / d
        return ux, uy, float(np.hypot(a[0] - ux, a[1] - uy))

    def outside(circle, upto):
        far = np.hypot(pts[:upto, 0] - circle[0], pts[:upto, 1] - circle[1]) > circle[2] * (1 + 1e-12) + 1e-12
        hit = np.flatnonzero(far)
        return int(hit[0]) if len(hit) else -1

    circle = (float(pts[0, 0]), float(pts[0, 1]), 0.0)
    while (i := outside(circle, len(pts))) >= 0:
        circle = (float(pts[i, 0]), float(pts[i, 1]), 0.0)
        while (j := outside(circle, i)) >= 0:
            circle = of_two(pts[i], pts[j])
            while (k := outside(circle, j)) >= 0:
                circle = of_three(pts[i], pts[j], pts[k])
    return circle


def reock_scores(districts: DataFrame, key: str, rings: str = "rings", name: str = "reock") -> DataFrame:
    """`(key, name)`: area of each district over the area of its smallest enclosing circle."""
    shape = districts.select(key, F.expr(g.area(rings)).alias("_area"), F.expr(f"flatten({rings})").alias("_v"))
    field = districts.select(key).schema[0].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            radius = [enclosing_circle(np.array([[p["x"], p["y"]] for p in v]))[2] for v in pdf["_v"]]
            circle = np.pi * np.square(np.array(radius))
            value = np.where(circle > 0, pdf["_area"] / np.where(circle > 0, circle, 1), np.nan)
            yield pd.DataFrame({key: pdf[key], name: value})

    return shape.mapInPandas(score, f"`{key}` {field}, `{name}` double")

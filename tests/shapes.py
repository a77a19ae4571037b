"""Random shapes and plain numpy counterparts for the spatial tests."""

import numpy as np


def star(rng, cx, cy, r, n):
    """A simple, usually non-convex ring around a centre, counter-clockwise, closed."""
    ang = np.sort(rng.uniform(0, 2 * np.pi, n))
    rad = r * rng.uniform(0.4, 1.0, n)
    pts = [(float(cx + a * np.cos(t)), float(cy + a * np.sin(t))) for t, a in zip(ang, rad)]
    return [*pts, pts[0]]


def as_rings(*rings):
    return [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def inside(ring, px, py):
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def segment_distance(ring, px, py):
    best = np.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        d = np.array([x2 - x1, y2 - y1])
        t = np.clip(((px - x1) * d[0] + (py - y1) * d[1]) / (d @ d), 0, 1)
        best = min(best, np.hypot(px - x1 - t * d[0], py - y1 - t * d[1]))
    return best

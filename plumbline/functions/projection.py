"""Map projections as SQL expressions: ellipsoidal closed forms on GRS80.

4326 and 4269 count as the same longitude and latitude. Points far outside the
standard parallels are computed, but their distortion is undefined.
"""

from __future__ import annotations

from math import cos, log, pi, radians, sin, sqrt, tan

# GRS80 semi-major axis and flattening.
_A = 6378137.0
_F = 1 / 298.257222101
_E2 = _F * (2 - _F)
_E = sqrt(_E2)

# Standard parallels, latitude and longitude of origin (degrees).
ALBERS_5070 = (29.5, 45.5, 23.0, -96.0)
LAMBERT_3968 = (37.0, 39.5, 36.0, -79.5)


def _m(phi: float) -> float:
    return cos(phi) / sqrt(1 - _E2 * sin(phi) ** 2)


def _q(phi: float) -> float:
    s = sin(phi)
    return (1 - _E2) * (s / (1 - _E2 * s * s) - log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


def _t(phi: float) -> float:
    s = sin(phi)
    return tan(pi / 4 - phi / 2) / ((1 - _E * s) / (1 + _E * s)) ** (_E / 2)


def _polar(rho: str, theta: str, rho0: float) -> str:
    return f"named_struct('x', {rho} * sin({theta}), 'y', {rho0!r}D - {rho} * cos({theta}))"


def albers(lon: str, lat: str, params: tuple = ALBERS_5070) -> str:
    """Equal-area point in metres (EPSG:5070 by default)."""
    p1, p2, p0 = (radians(v) for v in params[:3])
    n = (_m(p1) ** 2 - _m(p2) ** 2) / (_q(p2) - _q(p1))
    c = _m(p1) ** 2 + n * _q(p1)
    s = f"sin(radians({lat}))"
    q = (
        f"({1 - _E2!r}D * ({s} / (1 - {_E2!r}D * {s} * {s}) - "
        f"ln((1 - {_E!r}D * {s}) / (1 + {_E!r}D * {s})) / {2 * _E!r}D))"
    )
    rho = f"({_A!r}D * sqrt({c!r}D - {n!r}D * {q}) / {n!r}D)"
    theta = f"({n!r}D * radians({lon} - ({params[3]!r}D)))"
    return _polar(rho, theta, _A * sqrt(c - n * _q(p0)) / n)


def lambert(lon: str, lat: str, params: tuple = LAMBERT_3968) -> str:
    """Conformal point in metres (EPSG:3968 by default)."""
    p1, p2, p0 = (radians(v) for v in params[:3])
    n = (log(_m(p1)) - log(_m(p2))) / (log(_t(p1)) - log(_t(p2)))
    big_f = _m(p1) / (n * _t(p1) ** n)
    s = f"sin(radians({lat}))"
    t = (
        f"(tan({pi / 4!r}D - radians({lat}) / 2) / "
        f"pow((1 - {_E!r}D * {s}) / (1 + {_E!r}D * {s}), {_E / 2!r}D))"
    )
    rho = f"({_A * big_f!r}D * pow({t}, {n!r}D))"
    theta = f"({n!r}D * radians({lon} - ({params[3]!r}D)))"
    return _polar(rho, theta, _A * big_f * _t(p0) ** n)


def project_rings(rings: str, transform: str = "albers") -> str:
    """Every vertex of `rings` projected with `albers` or `lambert`."""
    project = {"albers": albers, "lambert": lambert}[transform]
    return f"transform({rings}, pr_r -> transform(pr_r, pr_p -> {project('pr_p.x', 'pr_p.y')}))"

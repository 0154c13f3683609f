"""Geodesy as Column expressions.

Spark 4.1 has no distance functions, so these are expressions that run inside
codegen:

* ``sphere_distance_m``  haversine on a sphere of R = 6371008.771415 m
  (the reference's sphere distance).
* ``with_near_distance`` geodesic distance on WGS84 by a closed formula.
* ``with_spheroid_distance`` geodesic distance on WGS84 (the reference's
  geography distance), to 2 mm; see there for antipodes.
* ``with_line_distance``  geodesic distance from a point to the next point of
  a great-circle segment.

The geocell joins built on these live in ``contrail.operators.geojoin``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.codes import EARTH_RADIUS_SPHERE_M, WGS84_A, WGS84_F


def _d(c) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast("double")


def valid_coordinates(lat, lon) -> Column:
    """lat in [-90, 90] and lon in [-180, 180]; null in -> null out."""
    return _d(lat).between(-90, 90) & _d(lon).between(-180, 180)


def sphere_distance_m(lat1, lon1, lat2, lon2, r: float = EARTH_RADIUS_SPHERE_M) -> Column:
    p1, p2 = F.radians(_d(lat1)), F.radians(_d(lat2))
    dp = p2 - p1
    dl = F.radians(_d(lon2)) - F.radians(_d(lon1))
    h = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * r) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


# -- distances on the WGS84 ellipsoid -----------------------------------------------------------
#
# Vincenty's inverse problem, unrolled: the longitude on the auxiliary sphere is found by three
# rounds of two steps and one extrapolation, then a last step that also tells whether it settled.
# Written as levels of columns, each a projection over the one before, so that no expression is
# computed twice and all of it stays in generated code.

_B = WGS84_A * (1 - WGS84_F)
_EP2 = (WGS84_A**2 - _B**2) / _B**2
_N = WGS84_F / (2 - WGS84_F)
#: Change of the longitude in the last step up to which it counts as settled, in radians.
SETTLED = 1e-9
_ROUNDS = 3


def _meridian(lat: str) -> str:
    """Length of the meridian from the equator to a latitude in radians (series in the third flattening)."""
    n = _N
    return (f"{WGS84_A / (1 + n)!r}D * ({1 + n**2 / 4 + n**4 / 64!r}D * {lat} - {1.5 * (n - n**3 / 8)!r}D * sin(2 * {lat})"
            f" + {15 / 16 * (n**2 - n**4 / 4)!r}D * sin(4 * {lat}) - {35 / 48 * n**3!r}D * sin(6 * {lat}))")


HALF_MERIDIAN_M = 2 * WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64) * math.pi / 2


def spheroid_levels(lat1: str, lon1: str, lat2: str, lon2: str, out: str, t: str = "_g") -> list[dict[str, str]]:
    """Levels of columns (name: expression over earlier levels), the last of which is ``out`` (metres).

    Accurate to 2 mm while the points are not within about 0.6 degrees (66 km) of each other's
    antipodes. There the longitude need not settle, and the distance is that over the nearer pole,
    an upper bound (exact for antipodes, at most 35 km too long). Null in, null out.
    """
    levels: list[dict[str, str]] = []

    def put(**columns: str) -> list[str]:
        levels.append({f"{t}_{n}": e for n, e in columns.items()})
        return list(levels[-1])

    f = repr(WGS84_F) + "D"
    p1, p2, d = put(p1=f"radians(CAST({lat1} AS DOUBLE))", p2=f"radians(CAST({lat2} AS DOUBLE))", d=f"radians(CAST({lon2} AS DOUBLE)) - radians(CAST({lon1} AS DOUBLE))")
    d, u1, u2 = put(l=f"{d} - {2 * math.pi!r}D * rint({d} / {2 * math.pi!r}D)", u1=f"atan({1 - WGS84_F!r}D * tan({p1}))", u2=f"atan({1 - WGS84_F!r}D * tan({p2}))")
    su1, cu1, su2, cu2 = put(su1=f"sin({u1})", cu1=f"cos({u1})", su2=f"sin({u2})", cu2=f"cos({u2})")

    def sphere(k: str, lam: str) -> tuple[str, str, str, str]:
        """Sine and cosine of the arc, sine of the azimuth at the equator, cosine of twice the arc to its middle."""
        sx, cx = put(**{f"sx{k}": f"sqrt(pow({cu2} * sin({lam}), 2) + pow({cu1} * {su2} - {su1} * {cu2} * cos({lam}), 2))", f"cx{k}": f"{su1} * {su2} + {cu1} * {cu2} * cos({lam})"})
        (sa,) = put(**{f"sa{k}": f"if({sx} = 0, 0D, {cu1} * {cu2} * sin({lam}) / {sx})"})
        (cm,) = put(**{f"cm{k}": f"if(1 - {sa} * {sa} < 1e-15D, 0D, {cx} - 2 * {su1} * {su2} / (1 - {sa} * {sa}))"})
        return sx, cx, sa, cm

    def step(k: str, lam: str) -> str:
        sx, cx, sa, cm = sphere(k, lam)
        c = f"({WGS84_F / 16!r}D * (1 - {sa} * {sa}) * (4 + {f} * (4 - 3 * (1 - {sa} * {sa}))))"
        return put(**{f"lam{k}": f"{d} + (1 - {c}) * {f} * {sa} * (atan2({sx}, {cx}) + {c} * {sx} * ({cm} + {c} * {cx} * (2 * {cm} * {cm} - 1)))"})[0]

    x = d
    for r in range(_ROUNDS):
        y = step(f"{r}a", x)
        z = step(f"{r}b", y)
        bend = f"({z} - 2 * {y} + {x})"
        (x,) = put(**{f"x{r}": f"CASE WHEN abs({bend}) < 1e-15D THEN {z} ELSE {x} - ({y} - {x}) * ({y} - {x}) / {bend} END"})
    last = step("l", x)
    sx, cx, sa, cm = sphere("z", last)
    (q,) = put(q=f"(1 - {sa} * {sa}) * {_EP2!r}D")
    a, b = put(a=f"1 + {q} / 16384 * (4096 + {q} * ({q} * (320 - 175 * {q}) - 768))", b=f"{q} / 1024 * (256 + {q} * ({q} * (74 - 47 * {q}) - 128))")
    ds = f"({b} * {sx} * ({cm} + {b} / 4 * ({cx} * (2 * {cm} * {cm} - 1) - {b} / 6 * {cm} * (4 * {sx} * {sx} - 3) * (4 * {cm} * {cm} - 3))))"
    pole = f"{HALF_MERIDIAN_M!r}D - abs({_meridian(p1)} + {_meridian(p2)})"
    settled = f"coalesce(abs({last} - {x}) <= {SETTLED!r}D, false)"
    levels.append({out: f"CASE WHEN {p1} IS NULL OR {p2} IS NULL OR {d} IS NULL THEN NULL WHEN {settled} THEN {_B!r}D * {a} * (atan2({sx}, {cx}) - {ds}) ELSE {pole} END"})
    return levels


def foot_levels(plat: str, plon: str, lat1: str, lon1: str, lat2: str, lon2: str, t: str = "_f") -> list[dict[str, str]]:
    """Levels that end in ``{t}_lat``, ``{t}_lon``: the point of the great-circle segment A-B next to P.

    Beyond its ends, the nearer end (a segment of one point is that point).
    """
    ay, ax, by, bx, py, px = (f"{t}_{c}" for c in ("ay", "ax", "by", "bx", "py", "px"))
    levels = [{n: f"radians(CAST({e} AS DOUBLE))" for n, e in zip((ay, ax, by, bx, py, px), (lat1, lon1, lat2, lon2, plat, plon))}]

    def angle(y1: str, x1: str, y2: str, x2: str) -> str:
        return f"2 * asin(sqrt(least(1D, pow(sin(({y2} - {y1}) / 2), 2) + cos({y1}) * cos({y2}) * pow(sin(({x2} - {x1}) / 2), 2))))"

    def bearing(y: str, x: str) -> str:
        return f"atan2(sin({x} - {ax}) * cos({y}), cos({ay}) * sin({y}) - sin({ay}) * cos({y}) * cos({x} - {ax}))"

    ap, ab, bp, tp, tb, along, fy = (f"{t}_{c}" for c in ("ap", "ab", "bp", "tp", "tb", "along", "fy"))
    levels.append({ap: angle(ay, ax, py, px), ab: angle(ay, ax, by, bx), bp: angle(by, bx, py, px), tp: bearing(py, px), tb: bearing(by, bx)})
    levels.append({along: f"atan2(sin({ap}) * cos({tp} - {tb}), cos({ap}))"})
    levels.append({fy: f"asin(sin({ay}) * cos({along}) + cos({ay}) * sin({along}) * cos({tb}))"})
    inside = f"{along} >= 0 AND {along} <= {ab} AND {ab} > 0"
    fx = f"{ax} + atan2(sin({tb}) * sin({along}) * cos({ay}), cos({along}) - sin({ay}) * sin({fy}))"
    levels.append({f"{t}_lat": f"degrees(CASE WHEN {inside} THEN {fy} WHEN {ap} <= {bp} THEN {ay} ELSE {by} END)",
                   f"{t}_lon": f"degrees(CASE WHEN {inside} THEN {fx} WHEN {ap} <= {bp} THEN {ax} ELSE {bx} END)"})
    return levels


def line_levels(plat: str, plon: str, lat1: str, lon1: str, lat2: str, lon2: str, out: str) -> list[dict[str, str]]:
    """Levels that end in ``out``: metres from P to the segment A-B, the geodesic to its next point on the great circle."""
    return foot_levels(plat, plon, lat1, lon1, lat2, lon2) + spheroid_levels(plat, plon, "_f_lat", "_f_lon", out)


def _with_levels(df: DataFrame, levels: list[dict[str, str]]) -> DataFrame:
    """``df`` with the columns of the last level.

    That one passes through a generator: a filter on the result would else be rewritten through
    all levels, one copy of an expression for each use.
    """
    for columns in levels[:-1]:
        df = df.selectExpr("*", *[f"{e} AS {n}" for n, e in columns.items()])
    (out, expr), = levels[-1].items()
    df = df.selectExpr("*", f"explode(array({expr})) AS {out}")
    return df.drop(*[n for x in levels[:-1] for n in x])


def with_spheroid_distance(df: DataFrame, out: str, lat1: str, lon1: str, lat2: str, lon2: str) -> DataFrame:
    """``df`` with the geodesic distance in metres (see ``spheroid_levels``)."""
    return _with_levels(df, spheroid_levels(lat1, lon1, lat2, lon2, out))


def with_line_distance(df: DataFrame, out: str, plat: str, plon: str, lat1: str, lon1: str, lat2: str, lon2: str) -> DataFrame:
    """``df`` with the metres from P to the segment A-B (see ``line_levels``)."""
    return _with_levels(df, line_levels(plat, plon, lat1, lon1, lat2, lon2, out))


def near_levels(lat1: str, lon1: str, lat2: str, lon2: str, out: str, t: str = "_n") -> list[dict[str, str]]:
    """Levels that end in ``out``: the geodesic distance by the second-order closed formula for long lines.

    For searches and filters over many pairs: within 1 mm of the solver up to 100 km, 5 cm up to
    10,000 km and 1 m up to 16,000 km; coarse near antipodes.
    """
    tm, td, half, low, d, x, y, r, e = (f"{t}_{c}" for c in ("tm", "td", "half", "low", "d", "x", "y", "r", "e"))
    b1, b2 = (f"atan({1 - WGS84_F!r}D * tan(radians(CAST({c} AS DOUBLE))))" for c in (lat1, lat2))
    return [
        {tm: f"({b1} + {b2}) / 2", td: f"({b2} - {b1}) / 2", half: f"(radians(CAST({lon2} AS DOUBLE)) - radians(CAST({lon1} AS DOUBLE))) / 2"},
        {low: f"least(greatest(pow(sin({td}), 2) + (pow(cos({td}), 2) - pow(sin({tm}), 2)) * pow(sin({half}), 2), 0D), {1 - 1e-15!r}D)"},
        {d: f"2 * asin(sqrt({low}))", x: f"2 * pow(sin({tm}) * cos({td}), 2) / (1 - {low})", y: f"if({low} = 0, 0D, 2 * pow(sin({td}) * cos({tm}), 2) / {low})"},
        {r: f"if({d} = 0, 1D, {d} / sin({d}))", e: f"2 * cos({d})", f"{t}_u": f"{x} + {y}", f"{t}_v": f"{x} - {y}"},
        {out: f"{WGS84_A!r}D * sin({d}) * ({r} - {WGS84_F / 4!r}D * ({r} * {t}_u - {t}_v) + {WGS84_F**2 / 64!r}D * ({t}_u * (4 * {r} * {r} * {e} + ({r} - (4 * {r} * {r} * {e} - {e}) / 2) * {t}_u)"
              f" - {t}_v * (8 * {r} * {r} + {e} * {t}_v) + 4 * {r} * {r} * {t}_u * {t}_v))"},
    ]


def with_near_distance(df: DataFrame, out: str, lat1: str, lon1: str, lat2: str, lon2: str) -> DataFrame:
    """``df`` with the distance in metres by the closed formula (see ``near_levels``)."""
    return _with_levels(df, near_levels(lat1, lon1, lat2, lon2, out))

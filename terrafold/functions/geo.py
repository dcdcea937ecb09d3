"""Projections and polygon predicates as column expressions.

Formulas are Snyder's (1987) ellipsoidal Albers and Krueger's series for the transverse Mercator, on
WGS84. Each is a list of named steps in SQL that Spark and other engines share, so Catalyst sees plain
arithmetic and nothing leaves the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Steps = list[tuple[str, str]]

A, FLAT = 6378137.0, 1 / 298.257223563
E2 = FLAT * (2 - FLAT)
E = math.sqrt(E2)
ALBERS = {"p1": -24.0, "p2": -33.0, "lon0": 25.0, "lat0": 0.0}


def d(x: float) -> str:
    """A double literal in every dialect."""
    s = repr(float(x))
    s = s if "e" in s else f"{s}e0"
    return f"({s})" if x < 0 else s


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E * s) / (1 + E * s)) / (2 * E))


def _albers_constants() -> tuple[float, float, float]:
    p1, p2, lat0 = (math.radians(ALBERS[k]) for k in ("p1", "p2", "lat0"))

    def m(phi: float) -> float:
        return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)

    n = (m(p1) ** 2 - m(p2) ** 2) / (_q(p2) - _q(p1))
    c = m(p1) ** 2 + n * _q(p1)
    return n, c, A * math.sqrt(c - n * _q(lat0)) / n


def albers(lon: str, lat: str, x: str = "x", y: str = "y") -> Steps:
    """Equal-area metres from degrees."""
    n, c, rho0 = _albers_constants()
    return [
        ("_s", f"sin(radians({lat}))"),
        ("_q", f"{d(1 - E2)} * (_s / (1 - {d(E2)} * _s * _s) - ln((1 - {d(E)} * _s) / (1 + {d(E)} * _s)) / {d(2 * E)})"),
        ("_rho", f"{d(A)} * sqrt({d(c)} - {d(n)} * _q) / {d(n)}"),
        ("_t", f"{d(n)} * radians({lon} - {d(ALBERS['lon0'])})"),
        (x, "_rho * sin(_t)"),
        (y, f"{d(rho0)} - _rho * cos(_t)"),
    ]


def albers_inverse(x: str, y: str, lon: str = "lon", lat: str = "lat") -> Steps:
    """Degrees from equal-area metres, by the series of the authalic latitude (about a millimetre)."""
    n, c, rho0 = _albers_constants()
    e4, e6 = E2**2, E2**3
    series = ((2, E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040), (4, 23 * e4 / 360 + 251 * e6 / 3780), (6, 761 * e6 / 45360))
    sign = "-" if n < 0 else ""
    return [
        ("_q", f"({d(c)} - ({x} * {x} + ({d(rho0)} - {y}) * ({d(rho0)} - {y})) * {d(n * n / A / A)}) / {d(n * _q(math.pi / 2))}"),
        ("_b", "asin(_q)"),
        (lon, f"{d(ALBERS['lon0'])} + degrees(atan2({sign}{x}, {sign}({d(rho0)} - {y})) / {d(n)})"),
        (lat, "degrees(_b + " + " + ".join(f"{d(v)} * sin({k} * _b)" for k, v in series) + ")"),
    ]


_N = FLAT / (2 - FLAT)
_RADIUS = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)


def utm(lon: str, lat: str, zone: int | str, south: bool = True, x: str = "x", y: str = "y") -> Steps:
    """UTM metres from degrees. zone: a number or an expression."""
    xi = " + ".join(["_xi", *(f"{d(a)} * sin({2 * j} * _xi) * cosh({2 * j} * _eta)" for j, a in enumerate(_ALPHA, 1))])
    eta = " + ".join(["_eta", *(f"{d(a)} * cos({2 * j} * _xi) * sinh({2 * j} * _eta)" for j, a in enumerate(_ALPHA, 1))])
    return [
        ("_s", f"sin(radians({lat}))"),
        ("_l", f"radians({lon} - (6 * ({zone}) - 183))"),
        ("_u", f"sinh(atanh(_s) - {d(E)} * atanh({d(E)} * _s))"),
        ("_xi", "atan2(_u, cos(_l))"),
        ("_eta", "asinh(sin(_l) / sqrt(_u * _u + cos(_l) * cos(_l)))"),
        (x, f"{d(0.9996 * _RADIUS)} * ({eta}) + 500000"),
        (y, f"{d(0.9996 * _RADIUS)} * ({xi}) + {10000000 if south else 0}"),
    ]


_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)


_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def utm_inverse(x: str, y: str, zone: int | str, south: bool = True, lon: str = "lon", lat: str = "lat") -> Steps:
    """Degrees from UTM metres."""
    k = d(0.9996 * _RADIUS)
    xi = " - ".join(["_xi", *(f"{d(b)} * sin({2 * j} * _xi) * cosh({2 * j} * _eta)" for j, b in enumerate(_BETA, 1))])
    eta = " - ".join(["_eta", *(f"{d(b)} * cos({2 * j} * _xi) * sinh({2 * j} * _eta)" for j, b in enumerate(_BETA, 1))])
    return [
        ("_xi", f"({y} - {10000000 if south else 0}) / {k}"),
        ("_eta", f"({x} - 500000) / {k}"),
        ("_a", xi),
        ("_b", eta),
        ("_c", "asin(sin(_a) / cosh(_b))"),
        (lat, "degrees(_c + " + " + ".join(f"{d(v)} * sin({2 * j} * _c)" for j, v in enumerate(_DELTA, 1)) + ")"),
        (lon, f"(6 * ({zone}) - 183) + degrees(atan2(sinh(_b), cos(_a)))"),
    ]


def offset(lon: str, lat: str, azimuth: str, metres: str, lon2: str = "lon2", lat2: str = "lat2") -> Steps:
    """Where a short geodesic ends (second-order series in the ellipsoid's radii; below 0.1 mm at 10 m).
    A negative length goes the other way."""
    return [
        ("_az", f"radians({azimuth})"),
        ("_w", f"1 - {d(E2)} * sin(radians({lat})) * sin(radians({lat}))"),
        ("_rn", f"{d(A)} / sqrt(_w)"),
        ("_rm", f"{d(A * (1 - E2))} / (_w * sqrt(_w))"),
        ("_dn", f"({metres}) * cos(_az)"),
        ("_de", f"({metres}) * sin(_az)"),
        (lat2, f"{lat} + degrees(_dn / _rm - _de * _de * tan(radians({lat})) / (2 * _rn * _rm))"),
        (lon2, f"{lon} + degrees(_de / (_rn * cos(radians({lat}))) * (1 + _dn * tan(radians({lat})) / _rn))"),
    ]


def utm_epsg(lon: str, lat: str) -> str:
    """EPSG number of the zone of a place."""
    return f"CASE WHEN {lat} >= 0 THEN 32600 ELSE 32700 END + CAST(floor(({lon} + 180) / 6e0) AS INT) + 1"


def apply(df: DataFrame, steps: Steps) -> DataFrame:
    """Adds the steps' columns; those that begin with an underscore go again."""
    before = set(df.columns)
    for name, sql in steps:
        df = df.withColumn(name, F.expr(sql))
    return df.drop(*{n for n, _ in steps if n.startswith("_") and n not in before})


def render(inner: str, steps: Steps) -> str:
    """The same as nested SQL, for other engines."""
    names: list[str] = []
    for name, sql in steps:
        star = f"* EXCLUDE ({name})" if name in names else "*"
        inner = f"SELECT {star}, {sql} AS {name} FROM ({inner})"
        names.append(name)
    drop = sorted({n for n in names if n.startswith("_")})
    return f"SELECT * EXCLUDE ({', '.join(drop)}) FROM ({inner})" if drop else inner


def edges(ring: Column | str) -> Column:
    """Pairs a, b of neighbouring vertices. A null vertex parts one ring of a polygon from the next; it has no edges."""
    ring = F.col(ring) if isinstance(ring, str) else ring
    pairs = F.transform(F.sequence(F.lit(1), F.size(ring) - 1), lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, i + 1).alias("b")))
    return F.filter(pairs, lambda e: e["a"].isNotNull() & e["b"].isNotNull())


def in_edges(x: Column | str, y: Column | str, pairs: Column | str, boundary: bool = False) -> Column:
    """Whether a point lies within edges: a ray to the right crosses an odd number of them, so that holes and
    further parts need no rule of their own. Edges that the ray's latitude doesn't meet may be left out.

    boundary: what a point on an edge is."""
    x, y, pairs = (F.col(c) if isinstance(c, str) else c for c in (x, y, pairs))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / F.when(b["y"] == a["y"], 1e0).otherwise(b["y"] - a["y"]) + a["x"])

    inside, on = F.size(F.filter(pairs, crosses)) % 2 == 1, on_edges(x, y, pairs)
    return (inside | on) if boundary else (inside & ~on)


def on_edges(x: Column | str, y: Column | str, pairs: Column) -> Column:
    """Whether a point lies on one of the edges."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))

    def touches(e: Column) -> Column:
        a, b = e["a"], e["b"]
        flat = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"]) == 0
        return flat & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))

    return F.exists(pairs, touches)


def in_ring(x: Column | str, y: Column | str, ring: Column | str, boundary: bool = False) -> Column:
    """`in_edges` of a ring (array of structs x, y; first and last vertex equal; nulls between rings)."""
    return in_edges(x, y, edges(ring), boundary)

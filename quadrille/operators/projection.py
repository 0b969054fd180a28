"""Coordinate systems from their codes or definitions, as column expressions.

A system is named by a code (UTM, some equal-area systems, degrees) or by its definition in well-known text, as layers
and rasters carry it.  Transverse Mercator, Albers, Lambert conformal and Lambert azimuthal systems are computed from
their parameters on their own ellipsoid.  Datums are taken as one: they differ by less than a metre where these systems
are used.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class System:
    """``kind`` is degrees, transverse, albers, conformal or azimuthal; angles in degrees, lengths in metres."""

    kind: str
    lat0: float = 0.0
    lon0: float = 0.0
    parallels: tuple[float, ...] = ()
    scale: float = 1.0
    east: float = 0.0
    north: float = 0.0
    unit: float = 1.0
    a: float = 6378137.0
    flat: float = 1 / 298.257223563

    @property
    def e2(self) -> float:
        return self.flat * (2 - self.flat)


# Degrees, and equal-area systems of large regions by their codes.
DEGREES = ("EPSG:4326", "EPSG:4674", "EPSG:4269", "EPSG:4258")
EQUAL_AREA = {
    "ESRI:102033": System("albers", -32.0, -60.0, (-5.0, -42.0)),
    "EPSG:5070": System("albers", 23.0, -96.0, (29.5, 45.5)),
    "EPSG:3035": System("azimuthal", 52.0, 10.0, (), 1.0, 4321000.0, 3210000.0),
}
# Names of projections and of their parameters in well-known text, in lower case.
PROJECTIONS = {
    "transverse_mercator": "transverse", "gauss_kruger": "transverse", "albers_conic_equal_area": "albers", "albers": "albers", "lambert_conformal_conic": "conformal", "lambert_conformal_conic_2sp": "conformal",
    "lambert_conformal_conic_1sp": "conformal", "lambert_azimuthal_equal_area": "azimuthal",
}
PARAMETERS = {
    "lat0": ("latitude_of_origin", "latitude_of_center", "latitude_of_centre", "latitude_of_false_origin"),
    "lon0": ("central_meridian", "longitude_of_center", "longitude_of_centre", "longitude_of_origin", "longitude_of_false_origin"),
    "scale": ("scale_factor",),
    "east": ("false_easting", "easting_at_false_origin"),
    "north": ("false_northing", "northing_at_false_origin"),
}
TOKEN = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([A-Za-z_]\w*)|([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)|([\[\](),]))')


def parse_text(text: str) -> list:
    """Well-known text as nested lists: a keyword, then its values."""
    root: list = []
    stack, at = [root], 0
    while at < len(text.rstrip()):
        m = TOKEN.match(text, at)
        if not m:
            raise ValueError(f"not a definition of a coordinate system: {text[:60]!r}")
        at = m.end()
        quoted, word, number, mark = m.groups()
        if mark in ("[", "("):
            keyword = stack[-1].pop()
            inner: list = [keyword]
            stack[-1].append(inner)
            stack.append(inner)
        elif mark in ("]", ")"):
            if len(stack) == 1:
                raise ValueError("brackets do not match")
            stack.pop()
        elif mark != ",":
            stack[-1].append(quoted if quoted is not None else float(number) if number else word.upper())
    if len(stack) != 1 or len(root) != 1 or not isinstance(root[0], list):
        raise ValueError(f"not a definition of a coordinate system: {text[:60]!r}")
    return root[0]


def _find(node: list, keyword: str) -> list | None:
    """The first node of that keyword, nearest to the root."""
    level = [node]
    while level:
        for n in level:
            if n and n[0] == keyword:
                return n
        level = [c for n in level for c in n if isinstance(c, list)]
    return None


def from_text(text: str) -> System:
    """The system that well-known text defines."""
    node = parse_text(text)
    if node[0] == "COMPD_CS":
        node = next(c for c in node if isinstance(c, list))
    spheroid = _find(node, "SPHEROID")
    if node[0] not in ("PROJCS", "GEOGCS") or spheroid is None:
        raise ValueError(f"not a system on a plane or in degrees: {text[:60]!r}")
    body = {"a": spheroid[2], "flat": 1 / spheroid[3] if spheroid[3] else 0.0}
    if node[0] == "GEOGCS":
        return System("degrees", **body)
    projection = _find(node, "PROJECTION")[1].lower()
    if projection not in PROJECTIONS:
        raise ValueError(f"projection {projection}")
    given = {c[1].lower(): c[2] for c in node if isinstance(c, list) and c[0] == "PARAMETER"}
    unit = next((c[2] for c in node if isinstance(c, list) and c[0] == "UNIT"), 1.0)
    values = {k: next((given[n] for n in names if n in given), 1.0 if k == "scale" else 0.0) for k, names in PARAMETERS.items()}
    primem = _find(node, "PRIMEM")
    values |= {"east": values["east"] * unit, "north": values["north"] * unit, "lon0": values["lon0"] + (primem[2] if primem else 0.0)}
    parallels = tuple(given[k] for k in ("standard_parallel_1", "standard_parallel_2") if k in given)
    kind = PROJECTIONS[projection]
    if kind == "azimuthal" and abs(values["lat0"]) > 89.9:
        raise ValueError("the polar aspect of an azimuthal system is not known here")
    if kind in ("albers", "conformal") and not parallels:
        parallels = (values["lat0"],)
    return System(kind, parallels=parallels if kind in ("albers", "conformal") else (), unit=unit, **body, **values)


@lru_cache(maxsize=256)
def system(crs: str) -> System:
    """The system of a code (``EPSG:326zz``, ``327zz``, ``319zz``, those above) or of well-known text."""
    if crs in DEGREES:
        return System("degrees")
    if crs in EQUAL_AREA:
        return EQUAL_AREA[crs]
    if "[" in crs:
        return from_text(crs)
    code = int(crs.split(":")[-1])
    if 32601 <= code <= 32660 or 32701 <= code <= 32760:
        zone, south = code % 100, code >= 32700
    elif 31978 <= code <= 31985:
        zone, south = code - 31960, True
    else:
        raise ValueError(f"no definition of {crs}")
    return System("transverse", lon0=zone * 6 - 183.0, scale=0.9996, east=500000.0, north=10000000.0 if south else 0.0)


def _series(terms: tuple[float, ...], angle: Column) -> Column:
    return sum((c * F.sin(2 * j * angle) for j, c in enumerate(terms, 1)), F.lit(0.0))


# --- transverse Mercator, by the series of Krueger to the third power of the third flattening ------------------------------


def _krueger(s: System) -> tuple[float, tuple, tuple, tuple, float]:
    n = s.flat / (2 - s.flat)
    radius = s.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15)
    c, phi = 2 * math.sqrt(n) / (1 + n), math.radians(s.lat0)
    at = math.sinh(math.atanh(math.sin(phi)) - c * math.atanh(c * math.sin(phi))) if abs(s.lat0) < 90 else 0.0
    xi = math.atan(at)
    return radius, alpha, beta, delta, xi + sum(a * math.sin(2 * j * xi) for j, a in enumerate(alpha, 1))


def _transverse(s: System, lon: Column, lat: Column) -> tuple[Column, Column]:
    radius, alpha, _, _, origin = _krueger(s)
    n = s.flat / (2 - s.flat)
    phi, lam, c = F.radians(lat), F.radians(lon - s.lon0), 2 * math.sqrt(n) / (1 + n)
    sin = F.sin(phi)
    t = F.sinh(F.atanh(sin) - c * F.atanh(c * sin))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    e = eta + sum((a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(alpha, 1)), F.lit(0.0))
    north = xi + sum((a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(alpha, 1)), F.lit(0.0))
    return s.scale * radius * e, s.scale * radius * (north - origin)


def _untransverse(s: System, x: Column, y: Column) -> tuple[Column, Column]:
    radius, _, beta, delta, origin = _krueger(s)
    xi, eta = y / (s.scale * radius) + origin, x / (s.scale * radius)
    xi1 = xi - sum((b * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, b in enumerate(beta, 1)), F.lit(0.0))
    eta1 = eta - sum((b * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, b in enumerate(beta, 1)), F.lit(0.0))
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    return F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1))), F.degrees(chi + _series(delta, chi))


# --- equal-area systems, by authalic latitudes -----------------------------------------------------------------------------


def _q(s: System, sin_phi: float) -> float:
    """Twice the equal-area ordinate of a latitude."""
    e = math.sqrt(s.e2)
    return (1 - s.e2) * (sin_phi / (1 - s.e2 * sin_phi**2) + (math.atanh(e * sin_phi) / e if e else sin_phi))


def _q_of(s: System, phi: Column) -> Column:
    sin, e = F.sin(phi), math.sqrt(s.e2)
    return (1 - s.e2) * (sin / (1 - s.e2 * sin * sin) + (F.atanh(e * sin) / e if e else sin))


def _latitude(s: System, beta: Column) -> Column:
    """Latitude of an authalic one, by the series to the fourth power."""
    e2, e4, e6, e8 = (s.e2**k for k in (1, 2, 3, 4))
    terms = (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040 + 120389 * e8 / 1814400, 23 * e4 / 360 + 251 * e6 / 3780 + 102287 * e8 / 1814400, 761 * e6 / 45360 + 47561 * e8 / 1814400, 6059 * e8 / 1209600)
    return beta + _series(terms, beta)


def _m(s: System, phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - s.e2 * math.sin(phi) ** 2)


def _cone(s: System) -> tuple[float, float, float]:
    p = [math.radians(x) for x in s.parallels]
    if len(p) == 1 or abs(p[0] - p[1]) < 1e-12:
        n = math.sin(p[0])
    else:
        n = (_m(s, p[0]) ** 2 - _m(s, p[1]) ** 2) / (_q(s, math.sin(p[1])) - _q(s, math.sin(p[0])))
    c = _m(s, p[0]) ** 2 + n * _q(s, math.sin(p[0]))
    return n, c, s.a * math.sqrt(c - n * _q(s, math.sin(math.radians(s.lat0)))) / n


def _albers(s: System, lon: Column, lat: Column) -> tuple[Column, Column]:
    n, c, rho0 = _cone(s)
    rho, theta = s.a * F.sqrt(c - n * _q_of(s, F.radians(lat))) / n, n * F.radians(lon - s.lon0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def _unalbers(s: System, x: Column, y: Column) -> tuple[Column, Column]:
    n, c, rho0 = _cone(s)
    sign = 1.0 if n > 0 else -1.0
    rho2 = x * x + (rho0 - y) * (rho0 - y)
    beta = F.asin((c - rho2 * n * n / (s.a * s.a)) / n / _q(s, 1.0))
    return F.degrees(F.atan2(sign * x, sign * (rho0 - y)) / n), F.degrees(_latitude(s, beta))


def _around(s: System) -> tuple[float, float, float]:
    phi = math.radians(s.lat0)
    beta, radius = math.asin(_q(s, math.sin(phi)) / _q(s, 1.0)), s.a * math.sqrt(_q(s, 1.0) / 2)
    return beta, radius, s.a * _m(s, phi) / (radius * math.cos(beta))


def _azimuthal(s: System, lon: Column, lat: Column) -> tuple[Column, Column]:
    b0, radius, d = _around(s)
    lam, beta = F.radians(lon - s.lon0), F.asin(_q_of(s, F.radians(lat)) / _q(s, 1.0))
    b = radius * F.sqrt(2 / (1 + math.sin(b0) * F.sin(beta) + math.cos(b0) * F.cos(beta) * F.cos(lam)))
    return b * d * F.cos(beta) * F.sin(lam), b / d * (math.cos(b0) * F.sin(beta) - math.sin(b0) * F.cos(beta) * F.cos(lam))


def _unazimuthal(s: System, x: Column, y: Column) -> tuple[Column, Column]:
    b0, radius, d = _around(s)
    rho = F.sqrt((x / d) * (x / d) + (d * y) * (d * y))
    ce = 2 * F.asin(rho / (2 * radius))
    away = F.when(rho > 0, d * y * F.sin(ce) / rho).otherwise(0.0)
    beta = F.asin(F.cos(ce) * math.sin(b0) + away * math.cos(b0))
    lam = F.atan2(x * F.sin(ce), d * rho * math.cos(b0) * F.cos(ce) - d * d * y * math.sin(b0) * F.sin(ce))
    return F.degrees(lam), F.degrees(_latitude(s, beta))


# --- Lambert conformal, by conformal latitudes -----------------------------------------------------------------------------


def _t(s: System, phi: float) -> float:
    e = math.sqrt(s.e2)
    return math.exp(-math.atanh(math.sin(phi)) + e * math.atanh(e * math.sin(phi)))


def _conformal_cone(s: System) -> tuple[float, float, float]:
    p = [math.radians(x) for x in s.parallels]
    n = math.sin(p[0]) if len(p) == 1 or abs(p[0] - p[1]) < 1e-12 else math.log(_m(s, p[0]) / _m(s, p[1])) / math.log(_t(s, p[0]) / _t(s, p[1]))
    f = s.scale * s.a * _m(s, p[0]) / (n * _t(s, p[0]) ** n)
    return n, f, f * _t(s, math.radians(s.lat0)) ** n if abs(s.lat0) < 90 else 0.0


def _conformal(s: System, lon: Column, lat: Column) -> tuple[Column, Column]:
    n, f, rho0 = _conformal_cone(s)
    sin, e = F.sin(F.radians(lat)), math.sqrt(s.e2)
    rho, theta = f * F.exp(n * (e * F.atanh(e * sin) - F.atanh(sin))), n * F.radians(lon - s.lon0)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def _unconformal(s: System, x: Column, y: Column) -> tuple[Column, Column]:
    n, f, rho0 = _conformal_cone(s)
    sign = 1.0 if n > 0 else -1.0
    rho = F.sqrt(x * x + (rho0 - y) * (rho0 - y))
    chi = math.pi / 2 - 2 * F.atan(F.pow(rho / abs(f), F.lit(1 / n)))
    e2, e4, e6, e8 = (s.e2**k for k in (1, 2, 3, 4))
    terms = (e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360, 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520, 7 * e6 / 120 + 81 * e8 / 1120, 4279 * e8 / 161280)
    return F.degrees(F.atan2(sign * x, sign * (rho0 - y)) / n), F.degrees(chi + _series(terms, chi))


KINDS = {"transverse": (_transverse, _untransverse), "albers": (_albers, _unalbers), "azimuthal": (_azimuthal, _unazimuthal), "conformal": (_conformal, _unconformal)}


def from_lonlat(lon: Column, lat: Column, crs: str) -> tuple[Column, Column]:
    """Coordinates in a system, of degrees."""
    s = system(crs)
    if s.kind == "degrees":
        return lon, lat
    x, y = KINDS[s.kind][0](s, lon, lat)
    return (x + s.east) / s.unit, (y + s.north) / s.unit


def to_lonlat(x: Column, y: Column, crs: str) -> tuple[Column, Column]:
    s = system(crs)
    if s.kind == "degrees":
        return x, y
    lon, lat = KINDS[s.kind][1](s, x * s.unit - s.east, y * s.unit - s.north)
    return lon + s.lon0, lat


def project(x: Column, y: Column, source: str, target: str) -> tuple[Column, Column]:
    """Coordinates of one system in another."""
    same = source == target or system(source) == system(target)
    return (x, y) if same else from_lonlat(*to_lonlat(x, y, source), target)

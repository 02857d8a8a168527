"""Albers conic equal-area projection on an ellipsoid, as Column math.

Forward and inverse are closed-form (Snyder 1987, USGS Professional
Paper 1395, ch. 14 and eq. 3-18 for the authalic-latitude series), so
both compile into whole-stage codegen: no UDF, no iteration.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlbersParams:
    """Ellipsoid and cone parameters; derived constants are properties."""

    a: float
    inv_f: float
    lon0: float
    lat0: float
    lat1: float
    lat2: float
    false_easting: float = 0.0
    false_northing: float = 0.0

    @property
    def e2(self) -> float:
        f = 1.0 / self.inv_f
        return 2 * f - f * f

    @property
    def e(self) -> float:
        return math.sqrt(self.e2)

    def _m(self, phi_deg: float) -> float:
        s = math.sin(math.radians(phi_deg))
        return math.cos(math.radians(phi_deg)) / math.sqrt(1 - self.e2 * s * s)

    def _q(self, phi_deg: float) -> float:
        s = math.sin(math.radians(phi_deg))
        e, e2 = self.e, self.e2
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    @property
    def n(self) -> float:
        m1, m2 = self._m(self.lat1), self._m(self.lat2)
        q1, q2 = self._q(self.lat1), self._q(self.lat2)
        return (m1 * m1 - m2 * m2) / (q2 - q1)

    @property
    def C(self) -> float:
        m1 = self._m(self.lat1)
        return m1 * m1 + self.n * self._q(self.lat1)

    @property
    def rho0(self) -> float:
        return self.a * math.sqrt(self.C - self.n * self._q(self.lat0)) / self.n

    @property
    def q_pole(self) -> float:
        e, e2 = self.e, self.e2
        return 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))

    @property
    def series(self) -> tuple[float, float, float]:
        """Coefficients of sin 2β, sin 4β, sin 6β in the authalic inverse."""
        e2 = self.e2
        e4, e6 = e2 * e2, e2 * e2 * e2
        return (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040,
                23 * e4 / 360 + 251 * e6 / 3780,
                761 * e6 / 45360)

    # plain-Python versions, used for grid set-up on the driver and in tests
    def forward_py(self, lon: float, lat: float) -> tuple[float, float]:
        rho = self.a * math.sqrt(self.C - self.n * self._q(lat)) / self.n
        theta = self.n * math.radians(lon - self.lon0)
        return (self.false_easting + rho * math.sin(theta),
                self.false_northing + self.rho0 - rho * math.cos(theta))

    def inverse_py(self, x: float, y: float) -> tuple[float, float]:
        x -= self.false_easting
        y -= self.false_northing
        dy = self.rho0 - y
        rho = math.hypot(x, dy)
        theta = math.atan2(x, dy)
        q = (self.C - (rho * self.n / self.a) ** 2) / self.n
        beta = math.asin(max(-1.0, min(1.0, q / self.q_pole)))
        c2, c4, c6 = self.series
        phi = beta + c2 * math.sin(2 * beta) + c4 * math.sin(4 * beta) + c6 * math.sin(6 * beta)
        return self.lon0 + math.degrees(theta / self.n), math.degrees(phi)


# --- fixed values -----------------------------------------------------------
# The one target CRS of the reference: Albers conic equal-area on WGS 84,
# central meridian -96, latitude of origin 23, standard parallels 29.5 and
# 45.5, false easting/northing 0, metres; WGS 84 a = 6378137,
# 1/f = 298.257223563.
CONUS_ALBERS = AlbersParams(a=6378137.0, inv_f=298.257223563, lon0=-96.0, lat0=23.0,
                            lat1=29.5, lat2=45.5, false_easting=0.0, false_northing=0.0)
# ---------------------------------------------------------------------------


def _lit(v: float) -> Column:
    return F.lit(float(v))


def albers_forward(lon: Column | str, lat: Column | str,
                   p: AlbersParams = CONUS_ALBERS) -> tuple[Column, Column]:
    """(lon, lat) degrees -> (x, y) metres."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    e, e2 = p.e, p.e2
    s = F.sin(F.radians(lat))
    q = _lit(1 - e2) * (s / (_lit(1.0) - _lit(e2) * s * s)
                        - _lit(1 / (2 * e)) * F.log((_lit(1.0) - _lit(e) * s) / (_lit(1.0) + _lit(e) * s)))
    rho = _lit(p.a / p.n) * F.sqrt(_lit(p.C) - _lit(p.n) * q)
    theta = _lit(p.n) * F.radians(lon - _lit(p.lon0))
    x = _lit(p.false_easting) + rho * F.sin(theta)
    y = _lit(p.false_northing + p.rho0) - rho * F.cos(theta)
    return x, y


def albers_inverse(x: Column | str, y: Column | str,
                   p: AlbersParams = CONUS_ALBERS) -> tuple[Column, Column]:
    """(x, y) metres -> (lon, lat) degrees (cone with n > 0)."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    xs = x - _lit(p.false_easting)
    dy = _lit(p.rho0 + p.false_northing) - y
    rho = F.sqrt(xs * xs + dy * dy)
    theta = F.atan2(xs, dy)
    q = (_lit(p.C) - F.pow(rho * _lit(p.n / p.a), 2)) / _lit(p.n)
    beta = F.asin(F.least(F.greatest(q / _lit(p.q_pole), _lit(-1.0)), _lit(1.0)))
    c2, c4, c6 = p.series
    phi = (beta + _lit(c2) * F.sin(beta * 2) + _lit(c4) * F.sin(beta * 4)
           + _lit(c6) * F.sin(beta * 6))
    lon = _lit(p.lon0) + F.degrees(theta / _lit(p.n))
    return lon, F.degrees(phi)


def sql_forward(lon: str, lat: str, p: AlbersParams = CONUS_ALBERS) -> tuple[str, str]:
    """The same forward formula as ANSI-SQL text (for engine cross-checks)."""
    e, e2 = p.e, p.e2
    s = f"SIN(RADIANS({lat}))"
    q = (f"({1 - e2!r}E0 * ({s} / (1E0 - {e2!r}E0 * {s} * {s}) - {1 / (2 * e)!r}E0 * "
         f"LN((1E0 - {e!r}E0 * {s}) / (1E0 + {e!r}E0 * {s}))))")
    rho = f"({p.a / p.n!r}E0 * SQRT({p.C!r}E0 - {p.n!r}E0 * {q}))"
    theta = f"({p.n!r}E0 * RADIANS({lon} - ({p.lon0!r}E0)))"
    x = f"({p.false_easting!r}E0 + {rho} * SIN({theta}))"
    y = f"({p.false_northing + p.rho0!r}E0 - {rho} * COS({theta}))"
    return _fix_e(x), _fix_e(y)


def sql_inverse(x: str, y: str, p: AlbersParams = CONUS_ALBERS) -> tuple[str, str]:
    """The same inverse formula as ANSI-SQL text (for engine cross-checks)."""
    xs = f"({x} - ({p.false_easting!r}E0))"
    dy = f"(({p.rho0 + p.false_northing!r}E0) - {y})"
    rho = f"SQRT({xs} * {xs} + {dy} * {dy})"
    theta = f"ATAN2({xs}, {dy})"
    q = f"(({p.C!r}E0 - POWER({rho} * {p.n / p.a!r}E0, 2)) / {p.n!r}E0)"
    beta = f"ASIN(LEAST(GREATEST({q} / {p.q_pole!r}E0, -1E0), 1E0))"
    c2, c4, c6 = p.series
    phi = (f"({beta} + {c2!r}E0 * SIN(2 * {beta}) + {c4!r}E0 * SIN(4 * {beta}) "
           f"+ {c6!r}E0 * SIN(6 * {beta}))")
    lon = f"(({p.lon0!r}E0) + DEGREES({theta} / {p.n!r}E0))"
    return _fix_e(lon), _fix_e(f"DEGREES({phi})")


def _fix_e(sql: str) -> str:
    # repr() may already carry an exponent ("1e-05"); "1e-05E0" is not SQL.
    import re
    return re.sub(r"(\d(?:\.\d+)?e[-+]?\d+)E0", r"\1", sql)

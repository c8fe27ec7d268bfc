"""Lambert conformal conic projection (two standard parallels) as column expressions.

Both directions are built-in functions of their columns alone, so they stay in the JVM and in
the scan stage of what they project. The inverse latitude is a fixed number of fixed-point steps, each
of which shrinks the error by the square of the eccentricity (0.0067): eight reach double precision.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 8


@dataclass(frozen=True)
class LambertConformal:
    """Parameters in degrees and metres; ``unit`` is the length of a map unit in metres."""

    lat_1: float
    lat_2: float
    lat_0: float
    lon_0: float
    x_0: float
    y_0: float
    unit: float
    semi_major: float
    inverse_flattening: float

    @property
    def eccentricity(self) -> float:
        f = 1 / self.inverse_flattening
        return math.sqrt(f * (2 - f))

    def _m(self, lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (self.eccentricity * math.sin(lat)) ** 2)

    def _t(self, lat: float) -> float:
        e = self.eccentricity
        return math.tan(math.pi / 4 - lat / 2) / ((1 - e * math.sin(lat)) / (1 + e * math.sin(lat))) ** (e / 2)

    @property
    def constants(self) -> tuple[float, float, float]:
        """(n, a F, rho0) of the cone."""
        p1, p2, p0 = (math.radians(x) for x in (self.lat_1, self.lat_2, self.lat_0))
        n = math.log(self._m(p1) / self._m(p2)) / math.log(self._t(p1) / self._t(p2)) if p1 != p2 else math.sin(p1)
        af = self.semi_major * self._m(p1) / (n * self._t(p1) ** n)
        return n, af, af * self._t(p0) ** n

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """(x, y) in map units; NULL for NULL."""
        e = self.eccentricity
        n, af, rho_0 = self.constants
        phi = lat * F.lit(math.pi / 180)
        sine = F.lit(e) * F.sin(phi)
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - sine) / (1 + sine), F.lit(e / 2))
        rho = F.lit(af) * F.pow(t, F.lit(n))
        theta = F.lit(n) * ((lon - F.lit(self.lon_0)) * F.lit(math.pi / 180))
        x = F.lit(self.x_0) + rho * F.sin(theta)
        y = F.lit(self.y_0) + F.lit(rho_0) - rho * F.cos(theta)
        return x / F.lit(self.unit), y / F.lit(self.unit)

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(lon, lat) in degrees; NULL for NULL."""
        e = self.eccentricity
        n, af, rho_0 = self.constants
        east = x * F.lit(self.unit) - F.lit(self.x_0)
        north = F.lit(rho_0) - (y * F.lit(self.unit) - F.lit(self.y_0))
        sign = math.copysign(1.0, n)
        rho = F.lit(sign) * F.sqrt(east * east + north * north)
        t = F.pow(rho / F.lit(af), F.lit(1 / n))
        lon = F.atan2(F.lit(sign) * east, F.lit(sign) * north) / F.lit(n) * F.lit(180 / math.pi) + F.lit(self.lon_0)

        def step(known: Column, _: Column) -> Column:
            sine = F.lit(e) * F.sin(known["phi"])
            phi = F.lit(math.pi / 2) - 2 * F.atan(known["t"] * F.pow((1 - sine) / (1 + sine), F.lit(e / 2)))
            return F.struct(phi.alias("phi"), known["t"].alias("t"))

        start = F.struct((F.lit(math.pi / 2) - 2 * F.atan(t)).alias("phi"), t.alias("t"))
        phi = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["phi"]
        return lon, phi * F.lit(180 / math.pi)


# State plane of New York, Long Island zone, US survey feet (EPSG 2263, GRS 80).
STATE_PLANE_2263 = LambertConformal(
    lat_1=41 + 2 / 60, lat_2=40 + 40 / 60, lat_0=40 + 10 / 60, lon_0=-74.0, x_0=300000.0, y_0=0.0, unit=1200 / 3937,
    semi_major=6378137.0, inverse_flattening=298.257222101,
)

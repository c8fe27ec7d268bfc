"""Trip measures and KPI expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def distancia_km(millas: Column, factor: float = config.MILLA_A_KM) -> Column:
    return millas * F.lit(factor)


def duracion_min(ts_inicio: Column, ts_fin: Column) -> Column:
    """Minutes between two timestamps, from whole epoch seconds."""
    return (F.unix_seconds(ts_fin) - F.unix_seconds(ts_inicio)) / F.lit(60.0)


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` when ``den > 0``, else NULL (never raises under ANSI)."""
    return F.when(den > 0, num / den)


def velocidad_kmh(km: Column, minutos: Column) -> Column:
    return guarded_ratio(km, minutos / F.lit(60.0))


def desviacion_pct(minutos: Column, eta: Column) -> Column:
    """ETA deviation in percent of the reference ETA."""
    return F.when(eta > 0, (minutos - eta) / eta * F.lit(100))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                 radio: float = config.RADIO_TIERRA_KM) -> Column:
    """Great-circle distance; NULL if any coordinate is NULL.

    The asin argument is clamped to 1 (rounding can push it just above, and
    asin would return NaN). The clamp is a CASE, not ``least``: ``least``
    skips NULLs and would turn a missing centroid into half the globe.
    """
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    s = F.sqrt(a)
    return F.lit(2 * radio) * F.asin(F.when(s > 1.0, F.lit(1.0)).otherwise(s))

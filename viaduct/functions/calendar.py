"""Calendar attributes of a trip and of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def es_laborable(dia_semana: Column) -> Column:
    """Monday..Friday with Sunday = 1 numbering; no holiday calendar."""
    return dia_semana.between(2, 6)


def franja_horaria(hora: Column) -> Column:
    expr = None
    for lo, hi, label in config.FRANJAS:
        expr = F.when(hora.between(lo, hi), label) if expr is None else expr.when(hora.between(lo, hi), label)
    return expr.otherwise(config.FRANJA_RESTO)


def trip_calendar_columns(ts: Column) -> dict[str, Column]:
    """fecha, hora, dia_semana, es_laborable, franja_horaria of a start time."""
    hora = F.hour(ts)
    dia = F.dayofweek(ts)
    return {
        "fecha": F.to_date(ts),
        "hora": hora,
        "dia_semana": dia,
        "es_laborable": es_laborable(dia),
        "franja_horaria": franja_horaria(hora),
    }


def date_dimension_columns(fecha: Column) -> dict[str, Column]:
    """Attributes of one calendar date (ISO week number, calendar year)."""
    dia = F.dayofweek(fecha)
    return {
        "anio": F.year(fecha),
        "trimestre": F.quarter(fecha),
        "mes": F.month(fecha),
        "dia": F.dayofmonth(fecha),
        "dia_semana": dia,
        "nombre_dia": F.date_format(fecha, "EEEE"),
        "semana_anio": F.weekofyear(fecha),
        "es_laborable": es_laborable(dia),
    }

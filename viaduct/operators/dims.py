"""Date and operator dimensions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.calendar import date_dimension_columns
from .keys import sequential_key


def dim_tiempo(silver: DataFrame) -> DataFrame:
    """One row per distinct trip date, keyed 1..n in date order."""
    d = silver.select("fecha").filter(F.col("fecha").isNotNull()).distinct()
    d = d.withColumns(date_dimension_columns(F.col("fecha")))
    return sequential_key(d, "fecha", "sk_tiempo")


def operator_name(id_col) -> F.Column:
    names = F.create_map(*[F.lit(x) for x in chain.from_iterable(config.OPERADORES.items())])
    return F.coalesce(names[id_col], F.lit(config.OPERADOR_DESCONOCIDO))


def dim_operador(silver: DataFrame) -> DataFrame:
    """One row per known operator id, keyed 1..n in id order."""
    d = silver.select("id_operador").filter(F.col("id_operador").isNotNull()).distinct()
    d = d.withColumn("nombre_operador", operator_name(F.col("id_operador")))
    return sequential_key(d, "id_operador", "sk_operador")

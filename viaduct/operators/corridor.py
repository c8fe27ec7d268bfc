"""Corridor KPIs: reference ETA, p90, reliability and ETA deviation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics
from ..functions.calendar import trip_calendar_columns

CORRIDOR_KEYS = ("id_zona_origen", "id_zona_destino", "franja_horaria", "es_laborable")
PERCENTILE_ACCURACY = 10_000


def add_calendar(df: DataFrame, ts_col: str = "ts_inicio") -> DataFrame:
    """fecha, hora, dia_semana, es_laborable, franja_horaria."""
    return df.withColumns(trip_calendar_columns(F.col(ts_col)))


def corridor_stats(df: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    """p50 (reference ETA), p90 and trip count per corridor, and reliability.

    Both percentiles come from one approximate-percentile sketch per corridor;
    sketches merge map-side, so a corridor holding a third of all trips costs
    one bounded sketch per task rather than a task holding the whole group.
    The percentile is an observed value (exact while a corridor has fewer
    rows than ``accuracy``).
    """
    q = F.percentile_approx("duracion_min", [0.5, 0.9], accuracy)
    return (
        df.groupBy(*CORRIDOR_KEYS)
        .agg(q.alias("_q"), F.count(F.lit(1)).alias("n_servicios_corredor"))
        .select(
            *CORRIDOR_KEYS,
            F.col("_q")[0].alias("eta_referencia_min"),
            F.col("_q")[1].alias("p90_min"),
            "n_servicios_corredor",
        )
        .withColumn("fiabilidad_corredor", metrics.guarded_ratio(F.col("p90_min"), F.col("eta_referencia_min")))
    )


def attach_corridor_kpis(df: DataFrame, corridors: DataFrame) -> DataFrame:
    """Join corridor KPIs back to each trip and add its ETA deviation.

    The corridor table has at most zones² × 10 rows. The planner broadcasts it
    while it is small; beyond that it shuffles and AQE splits a skewed corridor.
    """
    joined = df.join(corridors, list(CORRIDOR_KEYS), "left")
    return joined.withColumn(
        "desviacion_eta_pct", metrics.desviacion_pct(F.col("duracion_min"), F.col("eta_referencia_min"))
    )

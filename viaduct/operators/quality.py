"""Derived measures, ordered quality rules and the accept/quarantine split.

Every row is tagged with the code of the *first* rule it breaks; NULL means
accepted. A NULL comparison falls through a rule, so a NULL distance (and
speed) is accepted, while NaN compares above every bound and is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..config import Thresholds
from ..functions import metrics

MOTIVO = "motivo_rechazo"


def derive_metrics(df: DataFrame, milla_a_km: float = config.MILLA_A_KM) -> DataFrame:
    """distancia_km, duracion_min, velocidad_kmh."""
    km = metrics.distancia_km(F.col("distancia_millas"), milla_a_km)
    minutes = metrics.duracion_min(F.col("ts_inicio"), F.col("ts_fin"))
    return df.withColumns({"distancia_km": km, "duracion_min": minutes}).withColumn(
        "velocidad_kmh", metrics.velocidad_kmh(F.col("distancia_km"), F.col("duracion_min"))
    )


def rejection_reason(t: Thresholds = Thresholds()):
    c = F.col
    return (
        F.when(c("ts_inicio").isNull() | c("ts_fin").isNull(), config.R1_TEMPORAL_NULO)
        .when(c("ts_fin") <= c("ts_inicio"), config.R1_TEMPORAL_INCOHERENTE)
        .when((c("duracion_min") < t.min_duracion_min) | (c("duracion_min") > t.max_duracion_min), config.R2_DURACION)
        .when(
            (c("distancia_km") < t.min_distancia_km) | (c("distancia_km") > t.max_distancia_km), config.R3_DISTANCIA
        )
        .when(
            (c("velocidad_kmh") < t.min_velocidad_kmh) | (c("velocidad_kmh") > t.max_velocidad_kmh),
            config.R4_VELOCIDAD,
        )
        .when(c("id_zona_origen").isNull() | c("id_zona_destino").isNull(), config.R7_ZONA_NULA)
    )


def tag_quality(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Add ``motivo_rechazo``."""
    return df.withColumn(MOTIVO, rejection_reason(thresholds))


def quarantine(tagged: DataFrame) -> DataFrame:
    """Rejected rows, every column kept, duplicates kept."""
    return tagged.filter(F.col(MOTIVO).isNotNull())


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(MOTIVO).isNull())

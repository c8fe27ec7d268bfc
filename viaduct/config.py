"""Pipeline constants and thresholds.

Every number and label below is a fixed value of the reference pipeline's
public contract; results depend on them being exactly these.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for right results)
# ---------------------------------------------------------------------------
MAX_DURACION_MIN = 240.0
MIN_DURACION_MIN = 0.5
MAX_DISTANCIA_KM = 150.0
MIN_DISTANCIA_KM = 0.1
MAX_VELOCIDAD_KMH = 120.0
MIN_VELOCIDAD_KMH = 1.0
MILLA_A_KM = 1.609344
RADIO_TIERRA_KM = 6371.0
VERSION_ESQUEMA = 1
TIPO_SERVICIO = "yellow"

# Quality rule codes, in evaluation order (first broken rule wins).
R1_TEMPORAL_NULO = "R1_temporal_nulo"
R1_TEMPORAL_INCOHERENTE = "R1_temporal_incoherente"
R2_DURACION = "R2_duracion"
R3_DISTANCIA = "R3_distancia"
R4_VELOCIDAD = "R4_velocidad"
R7_ZONA_NULA = "R7_zona_nula"
RULE_ORDER = (
    R1_TEMPORAL_NULO,
    R1_TEMPORAL_INCOHERENTE,
    R2_DURACION,
    R3_DISTANCIA,
    R4_VELOCIDAD,
    R7_ZONA_NULA,
)

# Time bands: (first hour, last hour, label); hours outside them are "noche".
FRANJAS = (
    (0, 5, "madrugada"),
    (6, 9, "punta_manana"),
    (10, 15, "valle"),
    (16, 19, "punta_tarde"),
)
FRANJA_RESTO = "noche"

# Operator names by id; any other id is "Desconocido".
OPERADORES = {
    1: "Creative Mobile Technologies",
    2: "Curb Mobility",
    6: "Myle Technologies",
    7: "Helix",
}
OPERADOR_DESCONOCIDO = "Desconocido"

# Reference query parameters (Q2 / Q4 HAVING thresholds, Q5 date range).
Q2_MIN_SERVICIOS = 500
Q4_MIN_SERVICIOS = 1000
Q5_DESDE = date(2023, 2, 1)
Q5_HASTA = date(2023, 2, 14)


# What silver reads: the document store or the flat export.
FUENTE_SILVER = "export"


@dataclass(frozen=True)
class Thresholds:
    """Quality-rule bounds; every bound is inclusive (values on it pass)."""

    min_duracion_min: float = MIN_DURACION_MIN
    max_duracion_min: float = MAX_DURACION_MIN
    min_distancia_km: float = MIN_DISTANCIA_KM
    max_distancia_km: float = MAX_DISTANCIA_KM
    min_velocidad_kmh: float = MIN_VELOCIDAD_KMH
    max_velocidad_kmh: float = MAX_VELOCIDAD_KMH

    def as_dict(self) -> dict[str, float]:
        return {
            "MAX_DURACION_MIN": self.max_duracion_min,
            "MIN_DURACION_MIN": self.min_duracion_min,
            "MAX_DISTANCIA_KM": self.max_distancia_km,
            "MIN_DISTANCIA_KM": self.min_distancia_km,
            "MAX_VELOCIDAD_KMH": self.max_velocidad_kmh,
            "MIN_VELOCIDAD_KMH": self.min_velocidad_kmh,
        }


@dataclass(frozen=True)
class QueryParams:
    """Parameters of the five reference queries."""

    q2_min_servicios: int = Q2_MIN_SERVICIOS
    q4_min_servicios: int = Q4_MIN_SERVICIOS
    q5_desde: date = Q5_DESDE
    q5_hasta: date = Q5_HASTA


@dataclass(frozen=True)
class PipelineConfig:
    thresholds: Thresholds = field(default_factory=Thresholds)
    version_esquema: int = VERSION_ESQUEMA
    # Surrogate fact keys are assigned per hash-prefix bucket; 4 hex digits
    # give 65,536 buckets, i.e. about 1.5 M rows per bucket at 10^11 rows.
    key_prefix_hex: int = 4


DEFAULT = PipelineConfig()

"""Fixed schemas: the trip source record and the gold star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw trip record as the monthly source files carry it (the eight fields the
# pipeline reads; any other source column is kept in the payload and hashed).
TRIP_SOURCE = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)
TIMESTAMP_FIELDS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")

INGESTA = T.StructType(
    [
        T.StructField("fecha_carga", T.TimestampType()),
        T.StructField("fichero_origen", T.StringType()),
        T.StructField("hash_registro", T.StringType()),
        T.StructField("version_esquema", T.IntegerType()),
    ]
)

ZONE_LOOKUP = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


# Gold star schema: column order, types and NOT NULL constraints are fixed.
DIM_ZONA = T.StructType(
    [
        _f("sk_zona", T.IntegerType(), False),
        _f("id_zona", T.IntegerType(), False),
        _f("nombre_zona", T.StringType()),
        _f("distrito", T.StringType()),
        _f("zona_servicio", T.StringType()),
        _f("lat", _dec(9, 6)),
        _f("lon", _dec(9, 6)),
        _f("long_via_km", _dec(10, 2)),
        _f("n_intersecciones", T.IntegerType()),
        _f("densidad_interseccion", _dec(12, 4)),
    ]
)

DIM_TIEMPO = T.StructType(
    [
        _f("sk_tiempo", T.IntegerType(), False),
        _f("fecha", T.DateType(), False),
        _f("anio", T.ShortType()),
        _f("trimestre", T.ShortType()),
        _f("mes", T.ShortType()),
        _f("dia", T.ShortType()),
        _f("dia_semana", T.ShortType()),
        _f("nombre_dia", T.StringType()),
        _f("semana_anio", T.ShortType()),
        _f("es_laborable", T.BooleanType()),
    ]
)

DIM_OPERADOR = T.StructType(
    [
        _f("sk_operador", T.IntegerType(), False),
        _f("id_operador", T.IntegerType(), False),
        _f("nombre_operador", T.StringType()),
    ]
)

FACT_SERVICIO = T.StructType(
    [
        _f("sk_servicio", T.LongType(), False),
        _f("sk_tiempo", T.IntegerType(), False),
        _f("sk_zona_origen", T.IntegerType(), False),
        _f("sk_zona_destino", T.IntegerType(), False),
        _f("sk_operador", T.IntegerType()),
        _f("hora", T.ShortType()),
        _f("franja_horaria", T.StringType()),
        _f("duracion_min", _dec(10, 2)),
        _f("distancia_km", _dec(10, 3)),
        _f("distancia_geodesica_km", _dec(10, 3)),
        _f("velocidad_kmh", _dec(10, 2)),
        _f("eta_referencia_min", _dec(10, 2)),
        _f("desviacion_eta_pct", _dec(10, 2)),
        _f("factor_rodeo", _dec(10, 4)),
        _f("fiabilidad_corredor", _dec(10, 4)),
        _f("importe_total", _dec(10, 2)),
        _f("n_pasajeros", T.ShortType()),
    ]
)

GOLD = {
    "dim_zona": DIM_ZONA,
    "dim_tiempo": DIM_TIEMPO,
    "dim_operador": DIM_OPERADOR,
    "fact_servicio": FACT_SERVICIO,
}

# Declared VARCHAR lengths of the warehouse DDL, checked by the conform report.
VARCHAR_LIMITS = {
    "dim_zona": {"nombre_zona": 120, "distrito": 60, "zona_servicio": 60},
    "dim_tiempo": {"nombre_dia": 20},
    "dim_operador": {"nombre_operador": 100},
    "fact_servicio": {"franja_horaria": 20},
}

# Primary / natural keys whose uniqueness the star joins rely on.
UNIQUE_KEYS = {
    "dim_zona": ("sk_zona", "id_zona"),
    "dim_tiempo": ("sk_tiempo", "fecha"),
    "dim_operador": ("sk_operador", "id_operador"),
    "fact_servicio": ("sk_servicio",),
}

"""Hand-written rule rows (FIXTURES.md §4): on, inside and outside every bound."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from viaduct import config
from viaduct.functions import metrics
from viaduct.operators import corridor, quality, zones
from viaduct.operators.dedup import dedup_by_key

BASE = datetime(2023, 2, 1, 8, 0, 0)
SCHEMA = "case string, ts_inicio timestamp, ts_fin timestamp, distancia_km double, id_zona_origen int, id_zona_destino int"


def row(case, secs=1800, km=10.0, start=BASE, origin=1, dest=2, end_null=False, start_null=False):
    end = None if end_null else start + timedelta(seconds=secs)
    return (case, None if start_null else start, end, km, origin, dest)


CASES = [
    (row("base"), None),
    (row("end null", end_null=True), config.R1_TEMPORAL_NULO),
    (row("start null", start_null=True), config.R1_TEMPORAL_NULO),
    (row("end = start", secs=0), config.R1_TEMPORAL_INCOHERENTE),
    (row("end before start", secs=-60), config.R1_TEMPORAL_INCOHERENTE),
    (row("29 s", secs=29), config.R2_DURACION),
    (row("14401 s", secs=14401), config.R2_DURACION),
    (row("30 s 0.5 km", secs=30, km=0.5), None),
    (row("14400 s 100 km", secs=14400, km=100.0), None),
    (row("0.099 km", km=0.099), config.R3_DISTANCIA),
    (row("150.001 km 100 min", secs=6000, km=150.001), config.R3_DISTANCIA),
    (row("NaN km", km=float("nan")), config.R3_DISTANCIA),
    (row("0.1 km 5 min", secs=300, km=0.1), None),
    (row("150 km 100 min", secs=6000, km=150.0), None),
    (row("0.1 km 30 min", secs=1800, km=0.1), config.R4_VELOCIDAD),
    (row("100 km 30 min", secs=1800, km=100.0), config.R4_VELOCIDAD),
    (row("20 km 10 min", secs=600, km=20.0), None),
    (row("1 km 60 min", secs=3600, km=1.0), None),
    (row("distance null", km=None), None),
    (row("origin null", origin=None), config.R7_ZONA_NULA),
    (row("destination null", dest=None), config.R7_ZONA_NULA),
    (row("first rule wins", secs=29, km=200.0, origin=None), config.R2_DURACION),
]


@pytest.fixture(scope="module")
def tagged(spark):
    df = spark.createDataFrame([c for c, _ in CASES], SCHEMA)
    df = df.withColumn("duracion_min", metrics.duracion_min(F.col("ts_inicio"), F.col("ts_fin"))).withColumn(
        "velocidad_kmh", metrics.velocidad_kmh(F.col("distancia_km"), F.col("duracion_min"))
    )
    return {r["case"]: r["motivo_rechazo"] for r in quality.tag_quality(df).collect()}


@pytest.mark.parametrize("case,expected", [(c[0], e) for c, e in CASES])
def test_rule(tagged, case, expected):
    assert tagged[case] == expected


def test_malformed_start_is_null_rule(spark):
    from viaduct.operators.flatten import flatten_documents

    docs = spark.createDataFrame(
        [(("not a date", "2023-02-01T08:30:00", 6.2, 1, 2), ("h", "f1"))],
        "payload struct<tpep_pickup_datetime:string,tpep_dropoff_datetime:string,trip_distance:double,"
        "PULocationID:int,DOLocationID:int>, _ingesta struct<hash_registro:string,fichero_origen:string>",
    )
    out = quality.tag_quality(quality.derive_metrics(flatten_documents(docs))).collect()[0]
    assert out["ts_inicio"] is None and out["motivo_rechazo"] == config.R1_TEMPORAL_NULO
    assert out["id_operador"] is None  # missing payload field -> typed NULL


def test_null_distance_passes_with_null_measures(spark):
    df = spark.createDataFrame([row("d", km=None)], SCHEMA)
    df = df.withColumn("duracion_min", metrics.duracion_min(F.col("ts_inicio"), F.col("ts_fin"))).withColumn(
        "velocidad_kmh", metrics.velocidad_kmh(F.col("distancia_km"), F.col("duracion_min"))
    )
    r = quality.tag_quality(df).collect()[0]
    assert r["motivo_rechazo"] is None and r["velocidad_kmh"] is None


def test_same_hash_twice_gives_one_row(spark):
    df = spark.createDataFrame(
        [("h1", "f2", 1.0), ("h1", "f1", 1.0), ("h2", "f1", 2.0)], "hash_registro string, fichero_origen string, x double"
    )
    out = sorted(dedup_by_key(df).collect())
    assert [(r.hash_registro, r.fichero_origen) for r in out] == [("h1", "f1"), ("h2", "f1")]


BANDS = [
    (datetime(2023, 2, 5, 23, 0), "noche", False),
    (datetime(2023, 2, 6, 0, 0), "madrugada", True),
    (datetime(2023, 2, 6, 5, 59), "madrugada", True),
    (datetime(2023, 2, 6, 6, 0), "punta_manana", True),
    (datetime(2023, 2, 6, 9, 59), "punta_manana", True),
    (datetime(2023, 2, 6, 10, 0), "valle", True),
    (datetime(2023, 2, 6, 15, 59), "valle", True),
    (datetime(2023, 2, 6, 16, 0), "punta_tarde", True),
    (datetime(2023, 2, 6, 19, 59), "punta_tarde", True),
    (datetime(2023, 2, 6, 20, 0), "noche", True),
]


def test_time_bands_and_workdays(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in BANDS], "ts_inicio timestamp")
    got = corridor.add_calendar(df).orderBy("ts_inicio").collect()
    assert [(r.franja_horaria, r.es_laborable) for r in got] == [(b, w) for _, b, w in BANDS]


def test_same_zone_and_unknown_zone_have_null_detour(spark):
    geo = spark.createDataFrame(
        [(1, 1, 40.5, -74.2), (2, 2, 40.6, -74.0), (3, 3, None, None)], "id_zona int, sk_zona int, lat double, lon double"
    )
    trips = spark.createDataFrame(
        [("same", 1, 1, 5.0), ("unknown", 1, 99, 5.0), ("nogeom", 1, 3, 5.0), ("ok", 1, 2, 30.0)],
        "case string, id_zona_origen int, id_zona_destino int, distancia_km double",
    )
    got = {r["case"]: r for r in zones.enrich_zones(trips, geo).collect()}
    assert got["same"]["factor_rodeo"] is None and got["same"]["distancia_geodesica_km"] == 0.0
    assert got["unknown"]["factor_rodeo"] is None and got["unknown"]["sk_zona_destino"] is None
    assert got["nogeom"]["factor_rodeo"] is None
    assert got["ok"]["factor_rodeo"] > 1.0


def test_operator_dimension(spark):
    from viaduct.operators.dims import dim_operador

    df = spark.createDataFrame([(1,), (3,), (None,), (1,)], "id_operador int")
    got = [(r.sk_operador, r.id_operador, r.nombre_operador) for r in dim_operador(df).orderBy("sk_operador").collect()]
    assert got == [(1, 1, "Creative Mobile Technologies"), (2, 3, "Desconocido")]

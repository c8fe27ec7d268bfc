"""Property test: Spark's rule tagging equals a plain-Python statement of the rules."""

import math
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viaduct import config
from viaduct.functions import metrics
from viaduct.operators import quality

BASE = datetime(2023, 3, 1, 12, 0, 0)

trip = st.tuples(
    st.one_of(st.none(), st.integers(-600, 20000)),  # end offset in seconds (None: no end)
    st.booleans(),  # start missing
    st.one_of(st.none(), st.just(float("nan")), st.floats(0, 200, allow_nan=False)),  # km
    st.one_of(st.none(), st.integers(1, 5)),  # origin
    st.one_of(st.none(), st.integers(1, 5)),  # destination
)


def expected(end, start_missing, km, origin, dest):
    if start_missing or end is None:
        return config.R1_TEMPORAL_NULO
    if end <= 0:
        return config.R1_TEMPORAL_INCOHERENTE
    minutes = end / 60.0
    if minutes < 0.5 or minutes > 240.0:
        return config.R2_DURACION
    if km is not None and (math.isnan(km) or km < 0.1 or km > 150.0):
        return config.R3_DISTANCIA
    if km is not None:
        speed = km / (minutes / 60.0)
        if speed < 1.0 or speed > 120.0:
            return config.R4_VELOCIDAD
    if origin is None or dest is None:
        return config.R7_ZONA_NULA
    return None


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(trip, min_size=50, max_size=200))
def test_tagging_matches_plain_rules(spark, trips):
    rows = []
    for i, (end, start_missing, km, origin, dest) in enumerate(trips):
        start = None if start_missing else BASE
        fin = None if end is None else BASE + timedelta(seconds=end)
        rows.append((i, start, fin, km, origin, dest))
    df = spark.createDataFrame(
        rows, "i int, ts_inicio timestamp, ts_fin timestamp, distancia_km double, id_zona_origen int, id_zona_destino int"
    )
    df = df.withColumn("duracion_min", metrics.duracion_min(F.col("ts_inicio"), F.col("ts_fin"))).withColumn(
        "velocidad_kmh", metrics.velocidad_kmh(F.col("distancia_km"), F.col("duracion_min"))
    )
    got = {r.i: r.motivo_rechazo for r in quality.tag_quality(df).select("i", "motivo_rechazo").collect()}
    assert got == {i: expected(*t) for i, t in enumerate(trips)}

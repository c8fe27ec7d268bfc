"""A key holding a third of all rows: results stay whole and exact."""

import glob
import math
import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from viaduct.operators.corridor import corridor_stats
from viaduct.operators.dedup import dedup_by_key
from viaduct.plans.silver import write_silver


def test_hot_group_of_copies(spark):
    n = 9000
    rows = [("hot" if i % 3 == 0 else f"h{i}", f"f{i % 97:02d}", 1.0) for i in range(n)]
    df = spark.createDataFrame(rows, "hash_registro string, fichero_origen string, x double").repartition(8)
    out = {r.hash_registro: r.fichero_origen for r in dedup_by_key(df).collect()}
    assert len(out) == 1 + n - n // 3
    assert out["hot"] == "f00"


def test_hot_corridor_percentiles_are_exact(spark):
    hot = [(1, 2, "valle", True, float((i * 7919) % 4999) / 10) for i in range(3000)]
    cold = [(i % 50, 3, "noche", False, float(i % 240)) for i in range(6000)]
    df = spark.createDataFrame(
        hot + cold, "id_zona_origen int, id_zona_destino int, franja_horaria string, es_laborable boolean, duracion_min double"
    ).repartition(8)
    got = [r for r in corridor_stats(df).collect() if r.id_zona_origen == 1 and r.id_zona_destino == 2][0]
    values = sorted(v for *_, v in hot)
    assert got.n_servicios_corredor == 3000
    assert got.eta_referencia_min == values[math.ceil(0.5 * 3000) - 1]
    assert got.p90_min == values[math.ceil(0.9 * 3000) - 1]


def test_hot_date_is_split_over_several_files(spark, tmp_dir):
    base = datetime(2023, 2, 1)
    rows = [(i, (base if i % 3 == 0 else base + timedelta(days=1 + i % 30)).date(), "x" * 50) for i in range(30000)]
    df = spark.createDataFrame(rows, "id long, fecha date, pad string").repartition(8)
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_silver(df, os.path.join(tmp_dir, "s"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    back = spark.read.parquet(os.path.join(tmp_dir, "s"))
    assert back.count() == 30000
    hot_files = glob.glob(os.path.join(tmp_dir, "s", "fecha=2023-02-01", "*.parquet"))
    assert len(hot_files) > 1
    assert back.filter(F.col("fecha") == "2023-02-01").count() == 10000

"""End-to-end run over monthly files written from the fixture."""

import os

import pytest
from pyspark.sql import functions as F

from viaduct.plans import run


def test_full_cycle_over_monthly_files(spark, warehouse, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    # one year of pickups keeps the date-partitioned silver small
    trips = warehouse.trips.filter(
        (F.col("fichero_origen") == "f1") & (F.year("tpep_pickup_datetime") == 1995)
    ).drop("fichero_origen")
    # three "months" of one year, as separate files
    for i, m in enumerate(("2023-01", "2023-02", "2023-03")):
        part = trips.filter(F.col("o_orderkey") % 3 == i)
        part.coalesce(1).write.parquet(os.path.join(raw, f"yellow_tripdata_{m}.parquet"))
    zones_csv = os.path.join(tmp_dir, "taxi_zone_lookup.csv")
    with open(zones_csv, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n")
        for r in warehouse.zone_lookup.collect():
            f.write(f'{r.LocationID},"{r.Borough}","{r.Zone}","{r.service_zone}"\n')
    out = os.path.join(tmp_dir, "out")

    ing = run.run_bronze(spark, raw, out)
    assert [x["coincide"] for x in ing["ficheros"]] == [True, True, True]
    assert [x["fichero"] for x in ing["ficheros"]] == [f"yellow_tripdata_{m}.parquet" for m in ("2023-01", "2023-02", "2023-03")]
    assert ing["documentos_finales"] == trips.count()
    assert all(x["bytes"] > 0 for x in ing["ficheros"])

    assert all(x["segundos"] >= 0 and x["registros_por_segundo"] > 0 for x in ing["ficheros"])
    assert run.read_report(spark, out, "informe_ingesta_bronze")["documentos_finales"] == ing["documentos_finales"]
    assert 0 <= ing["tamano_almacenado_mb"] <= ing["tamano_datos_mb"]

    run.run_export(spark, out)
    run.build_zone_dimension(spark, zones_csv, out)
    from_documents = run.run_silver(spark, out, source="documents")
    rep = run.run_silver(spark, out, source="export")
    assert {k: v for k, v in rep.items() if k != "segundos_pipeline"} == {k: v for k, v in from_documents.items() if k != "segundos_pipeline"}
    assert rep["registros_entrada"] == ing["documentos_finales"]
    assert rep["registros_rechazados"] == sum(rep["rechazos_por_regla"].values())
    assert rep["registros_aceptados"] == spark.read.parquet(os.path.join(out, "silver")).count()

    report = run.run_gold(spark, out)
    assert report["descartes"]["dim_zona"] == 0 and not [r for r in report["conformidad"] if r["comprobacion"] == "clave_duplicada" and r["n_filas"]]
    gold = run.load_gold(spark, out)
    assert gold["fact_servicio"].count() == rep["registros_aceptados"]
    assert not [n for n in os.listdir(os.path.join(out, "gold", "fact_servicio")) if n.startswith("_")]

    lay = run.run_layouts(spark, out, runs=1)
    assert lay["equivalencia"]["equivalente"] and len(lay["latencia"]) == 5
    assert run.read_report(spark, out, run.QUALITY_REPORT)["registros_entrada"] == rep["registros_entrada"]

    # a lost row is noticed at load
    short = gold | {"fact_servicio": gold["fact_servicio"].limit(rep["registros_aceptados"] - 1)}
    with pytest.raises(ValueError, match="fact_servicio"):
        run.check_load(spark, out, short)


def test_cli_zone_stage_with_centroids(spark, warehouse, tmp_dir):
    from viaduct.sources import fixture

    zones_csv = os.path.join(tmp_dir, "zones.csv")
    cent_csv = os.path.join(tmp_dir, "centroids.csv")
    with open(zones_csv, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n")
        for r in warehouse.zone_lookup.collect():
            f.write(f'{r.LocationID},"{r.Borough}","{r.Zone}","{r.service_zone}"\n')
    with open(cent_csv, "w") as f:
        f.write("LocationID,lat,lon\n")
        for r in fixture.fixture_zone_centroids(spark, "/root/testdata/sf0.001").collect():
            if r.lat is not None:
                f.write(f"{r.LocationID},{r.lat!r},{r.lon!r}\n")
    out = os.path.join(tmp_dir, "cli")
    run.main(["zones", "--zones", zones_csv, "--centroids", cent_csv, "--out", out])
    dim = spark.read.parquet(os.path.join(out, "dim_zona"))
    r = dim.agg(F.count("*").alias("n"), F.count("lat").alias("lat")).collect()[0]
    assert (r.n, r.lat) == (25, 24)

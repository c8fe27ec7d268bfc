"""Sources and sinks: write, read back, compare."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from viaduct import schemas
from viaduct.operators import zones as zone_ops
from viaduct.operators.conform import REASON, SchemaMismatch, conform
from viaduct.operators.flatten import flatten_documents
from viaduct.operators.sampling import first_rows_per_source
from viaduct.plans import gold as gold_plan
from viaduct.plans import reports
from viaduct.plans import silver as silver_plan
from viaduct.sources import bronze, zones


def _sources(df):
    return {r[0]: r[1] for r in df.groupBy("fichero_origen").count().collect()}


def test_scan_monthly_files_with_differing_types(spark, warehouse, tmp_dir):
    trips = warehouse.trips.drop("fichero_origen")
    a, b = trips.limit(300), trips.limit(200)
    month = lambda m: os.path.join(tmp_dir, f"yellow_tripdata_2023-{m}.parquet")
    a.write.parquet(month("01"))
    # the second month stores the passenger count as double (chunked export)
    b.withColumn("passenger_count", F.col("passenger_count").cast("double")).write.parquet(month("02"))
    # a third month with the first month's layout joins its scan
    a.write.parquet(month("03"))
    paths = bronze.trip_file_paths(spark, tmp_dir)
    assert {p.split("/")[-2] for p in paths} == {os.path.basename(month(m)) for m in ("01", "02", "03")}
    df = bronze.scan_trip_files(spark, paths, row_index_col="_fila", path_col="_ruta")
    # int and double have no common lossless type: the source's own text is stored
    assert df.schema["passenger_count"].dataType.simpleString() == "string"
    assert df.schema["trip_distance"].dataType == schemas.TRIP_SOURCE["trip_distance"].dataType
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    assert _sources(df) == {os.path.basename(month(m)): n for m, n in (("01", 300), ("02", 200), ("03", 300))}
    flat = flatten_documents(bronze.to_documents(df.drop("_fila", "_ruta")))
    assert flat.filter(F.col("n_pasajeros").isNull()).count() == 0
    assert bronze.trip_file_paths(spark, tmp_dir, "green") == []


def test_sample_is_per_source_not_per_part_file(spark, tmp_dir):
    spark.range(100).repartition(5).write.parquet(os.path.join(tmp_dir, "yellow_tripdata_2023-01.parquet"))
    spark.range(7).coalesce(1).write.parquet(os.path.join(tmp_dir, "yellow_tripdata_2023-02.parquet"))
    files = bronze.trip_file_paths(spark, tmp_dir)
    assert len(files) >= 6
    df = bronze.scan_trip_files(spark, files, row_index_col="_fila", path_col="_ruta")
    assert sorted(_sources(first_rows_per_source(df, 30)).values()) == [7, 30]
    assert sorted(_sources(first_rows_per_source(df, None)).values()) == [7, 100]


def _with_conf(spark, conf, run):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_sample_by_row_index_never_gathers_the_rows_by_file(spark, tmp_dir):
    spark.range(3000).repartition(3).write.parquet(os.path.join(tmp_dir, "yellow_tripdata_2023-01.parquet"))
    df = bronze.scan_trip_files(spark, bronze.trip_file_paths(spark, tmp_dir), row_index_col="_fila", path_col="_ruta")

    def run():
        out = first_rows_per_source(df, 1500)
        assert out.count() == 1500
        return out._jdf.queryExecution().executedPlan().toString()

    plan = _with_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "60"}, run)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_sampled_sources_have_as_many_part_files_as_their_rows_need(spark, monkeypatch):
    from conftest import SF001
    from viaduct.plans import registry

    made = []
    real = registry.scratch_path
    monkeypatch.setattr(registry, "scratch_path", lambda s, n: made.append(real(s, n)) or made[-1])
    conf = {
        "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    }
    rows = _with_conf(spark, conf, lambda: registry.bronze_sample_by_row_index(spark, SF001).count())
    files = bronze.trip_file_paths(spark, made[0])
    assert rows == 1000 + min(1000, spark.read.parquet(f"{made[0]}/yellow_tripdata_2023-02.parquet").count())
    assert sum("2023-01" in f for f in files) > 4


def test_raw_values_are_stored_as_the_source_holds_them(spark, tmp_dir):
    for m, rows, kind in (("01", [("4.2 mi", 1.7)], "string, passenger_count double"), ("02", [(3.5, 2.0)], "double, passenger_count double")):
        spark.createDataFrame(rows, f"trip_distance {kind}").write.parquet(os.path.join(tmp_dir, f"yellow_tripdata_2023-{m}.parquet"))
    docs = bronze.to_documents(bronze.scan_trip_files(spark, bronze.trip_file_paths(spark, tmp_dir)))
    assert sorted((r.payload.trip_distance, r.payload.passenger_count) for r in docs.collect()) == [("3.5", "2.0"), ("4.2 mi", "1.7")]
    flat = {r.fichero_origen[-10:-8]: r for r in flatten_documents(docs).collect()}
    assert (flat["01"].distancia_millas, flat["01"].n_pasajeros) == (None, 1)
    assert (flat["02"].distancia_millas, flat["02"].n_pasajeros) == (3.5, 2)


def test_the_hash_does_not_depend_on_what_is_loaded_with_it(spark, tmp_dir):
    one, two = (os.path.join(tmp_dir, f"yellow_tripdata_2023-0{i}.parquet") for i in (1, 2))
    spark.createDataFrame([(1, 2.5, 3)], "VendorID int, trip_distance double, passenger_count int").write.parquet(one)
    spark.createDataFrame([(1, "x", 2.0)], "VendorID long, nota string, passenger_count double").write.parquet(two)
    files = bronze.trip_file_paths(spark, tmp_dir)
    hashes = lambda paths: {r[0]: r[1] for r in bronze.to_documents(bronze.scan_trip_files(spark, paths)).select("_ingesta.fichero_origen", "_ingesta.hash_registro").collect()}
    together = hashes(files)
    for f in files:
        alone = hashes([f])
        assert alone.items() <= together.items()


def test_bronze_store_export_and_both_read_paths_agree(spark, warehouse, tmp_dir):
    docs = bronze.to_documents(warehouse.trips.withColumn("_propio", F.lit("kept")))
    store, export = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "export")
    bronze.write_documents(docs, store)
    bronze.write_documents(docs, store)  # full refresh: overwrite, no duplicates
    stored = bronze.read_documents(spark, store)
    assert stored.count() == docs.count()
    appended = os.path.join(tmp_dir, "bronze_append")
    bronze.write_documents(docs, appended, full_refresh=False)
    bronze.write_documents(docs, appended, full_refresh=False)
    assert bronze.read_documents(spark, appended).count() == 2 * docs.count()
    bronze.write_export(stored, export, rows_per_file=2000)
    assert len(glob.glob(os.path.join(export, "*.parquet"))) >= 3
    back = bronze.read_export(spark, export)
    assert back.schema["payload"].dataType.names == stored.schema["payload"].dataType.names  # leading underscores too
    a, b = flatten_documents(stored), flatten_documents(back)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ingest_report_counts_files(warehouse):
    rep = {r.fichero: r for r in reports.ingest_report(warehouse.trips, warehouse.documents).collect()}
    assert set(rep) == {"f1", "f2"} and all(r.coincide for r in rep.values())


def test_zone_lookup_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "taxi_zone_lookup.csv")
    with open(p, "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n2,"Queens","Jamaica Bay","Boro Zone"\n')
    df = zones.read_zone_lookup_csv(spark, p)
    assert df.schema == schemas.ZONE_LOOKUP and df.count() == 2


def test_silver_sink_partitioned_by_date(spark, warehouse, tmp_dir):
    s = warehouse.silver.filter(F.col("fecha").between("1995-01-01", "1995-01-31"))
    path = os.path.join(tmp_dir, "silver")
    silver_plan.write_silver(s, path)
    back = spark.read.parquet(path)
    assert back.count() == s.count()
    dirs = {os.path.basename(d) for d in glob.glob(os.path.join(path, "fecha=*"))}
    assert dirs == {f"fecha={r.fecha}" for r in s.select("fecha").distinct().collect()}
    plan = back.filter(F.col("fecha") == "1995-01-15")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fecha" in plan


def test_gold_sink_typed_load_and_no_marker_files(spark, warehouse, tmp_dir):
    for name, df in warehouse.gold.as_dict().items():
        back = gold_plan.write_table(df, tmp_dir, name)
        assert not glob.glob(os.path.join(tmp_dir, name, "_SUCCESS"))
        assert [(f.name, f.dataType) for f in back.schema.fields] == [
            (f.name, f.dataType) for f in schemas.GOLD[name].fields
        ]
        assert back.count() == df.count()


def test_values_that_do_not_fit_are_kept_as_rejects(spark):
    schema = schemas.FACT_SERVICIO
    row = {f.name: 1 for f in schema.fields} | {"franja_horaria": "valle"}
    rows = [row, row | {"factor_rodeo": 1e9}, row | {"importe_total": 999_999_999.0}, row | {"n_pasajeros": 99_999}, row | {"sk_zona_origen": None}]
    kinds = ", ".join(f"{f.name} " + ("string" if f.name == "franja_horaria" else "double" if f.dataType.simpleString().startswith("dec") else "long") for f in schema.fields)
    half = conform(spark.createDataFrame([tuple(float(v) if "double" in kinds.split(", ")[i] and v is not None else v for i, v in enumerate(r.values())) for r in rows], kinds), schema)
    assert half.rows.count() == 5 and half.rows.schema.names == schema.names
    assert sorted(r[REASON] for r in half.rejects.collect()) == [["factor_rodeo"], ["importe_total"], ["n_pasajeros"], ["sk_zona_origen"]]
    with pytest.raises(SchemaMismatch):
        conform(spark.range(1), schema)


def test_a_gold_run_fails_on_an_unknown_zone_and_keeps_the_row(spark, warehouse, tmp_dir):
    silver = warehouse.silver.limit(50).withColumn("sk_zona_origen", F.when(F.col("id_zona_origen") % 2 == 0, F.col("sk_zona_origen")))
    write = lambda df: warehouse._write(df, "test")
    with pytest.raises(SchemaMismatch, match="sk_zona_origen"):
        gold_plan.build_gold(silver, warehouse.dim_zona, os.path.join(tmp_dir, "gold"), write)
    kept = spark.read.parquet(os.path.join(tmp_dir, "gold_descartes", "fact_servicio"))
    assert kept.filter(F.array_contains(REASON, "sk_zona_origen")).count() == silver.filter("sk_zona_origen IS NULL").count() > 0


def test_repeated_centroids_do_not_multiply_zones(spark, warehouse):
    centroids = spark.createDataFrame([(1, 40.1, -74.0), (1, 40.2, -74.1), (2, None, None)], "LocationID int, lat double, lon double")
    geometry = zone_ops.zone_geometry(warehouse.zone_lookup, centroids)
    assert geometry.count() == 25 and geometry.filter("id_zona = 1").first().lat == 40.1


def test_quality_report_json(warehouse):
    obs = warehouse.write_quarantine()
    js = json.loads(reports.quality_report_json(obs, 4244, {"MAX_DURACION_MIN": 240.0}, 1.23))
    assert js["registros_rechazados"] == 1793 and js["registros_duplicados"] == 79
    assert list(js["rechazos_por_regla"])[0] == "R4_velocidad"


def test_storage_sizes_are_those_of_the_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(1000).select("id", F.lit("x").alias("a b")).repartition(3).write.parquet(path)
    size = reports.storage_sizes(spark.read.parquet(path)).first()
    files = glob.glob(f"{path}/*.parquet")
    assert (size.filas, size.archivos) == (1000, len(files)) and size.bytes_almacenados == sum(map(os.path.getsize, files))
    assert size.bytes_datos == sum(len(json.dumps({"id": i, "a b": "x"}, separators=(",", ":"))) for i in range(1000))
    assert tuple(reports.storage_sizes(spark.read.parquet(path).where("false")).first()) == (0, 0, 0, 0)


def test_stage_tables_store_hashes_at_half_their_text(spark, warehouse, tmp_dir):
    """Hexadecimal text holds four bits a character; the default codec keeps all eight."""
    hashes = warehouse.documents.select("_ingesta.hash_registro")
    hashes.coalesce(1).write.parquet(os.path.join(tmp_dir, "h"))
    size = sum(os.path.getsize(os.path.join(tmp_dir, "h", f)) for f in os.listdir(os.path.join(tmp_dir, "h")) if f.endswith(".parquet"))
    assert size < 0.7 * 32 * hashes.count()


def test_monthly_component_of_any_path(spark):
    name = "yellow_tripdata_2023-01.parquet"
    paths = [
        f"file:/a/{name}", f"file:/a/{name}/part-0.snappy.parquet", f"s3://b/{name}/x=1/{name}", name, "file:/a/other.parquet", "", "/", None,
        "/_tripdata_1.parquet", "/a_tripdata_.parquet", "/a_tripdata_b.parquet.crc", "/a_tripdata_b.csv/c_tripdata_d.parquet", "/_tripdata__tripdata_x.parquet",
        "/a_tripdata_b_tripdata_c.parquet/p", "/a_tripdata_.parquet.parquet", "/é_tripdata_ñ.parquet/p", "/a_tripdata_/b_tripdata_c.parquet",
    ]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select("p", bronze.monthly_component(F.col("p")).alias("a"), F.regexp_extract("p", r"([^/]+_tripdata_[^/]+\.parquet)", 1).alias("b")).collect()
    assert [(r.p, r.a) for r in got] == [(r.p, r.b) for r in got]
    assert got[0].a == got[1].a == name

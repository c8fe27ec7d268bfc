"""End-to-end runs over real monthly trip files, with JSON reports.

    python -m viaduct.plans.run all --raw DIR --zones taxi_zone_lookup.csv --out DIR

Stages (each can run alone): ``bronze`` (scan monthly files, write the
document store, ingestion report), ``export`` (flat interchange copy), ``silver`` (quality,
de-duplication, KPIs, zones; silver partitioned by date, quarantine, quality
report), ``gold`` (star schema with conformance report and rejects),
``layouts`` (load check against the quality report, re-sort, optimised and control copies,
statistics, equivalence guard, latency report). Reports are JSON text written by Spark
to ``<out>/evidencias``, so ``--out`` can be any folder that Spark reaches.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config, schemas
from ..config import PipelineConfig
from ..operators import zones
from ..operators.sampling import first_rows_per_source
from ..session import build_session, scratch_path
from ..sources import bronze
from ..sources import zones as zone_sources
from . import gold as gold_plan
from . import layout
from . import queries as Q
from . import reports
from . import silver as silver_plan

QUALITY_REPORT = "informe_calidad_silver"


def _paths(out: str) -> dict[str, str]:
    names = ("bronze", "export", "silver", "cuarentena", "gold", "dim_zona", "evidencias")
    return {n: f"{out.rstrip('/')}/{n}" for n in names}


def write_report(spark: SparkSession, out: str, name: str, payload: dict) -> None:
    """One JSON document as a line of text, through Spark's file system; what an earlier run wrote is kept."""
    path = f"{_paths(out)['evidencias']}/{name}"
    body = json.dumps({**payload, "generado": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}, ensure_ascii=False, default=str)
    spark.createDataFrame([(body,)], "value string").coalesce(1).write.mode("append").text(path)


def read_report(spark: SparkSession, out: str, name: str) -> dict:
    """The latest report of that name."""
    rows = spark.read.text(f"{_paths(out)['evidencias']}/{name}").collect()  # one row per run
    return max((json.loads(r["value"]) for r in rows), key=lambda x: x["generado"])


def run_bronze(spark: SparkSession, raw_dir: str, out: str, service: str = config.TIPO_SERVICIO,
               sample: int | None = None) -> dict:
    """Monthly files → document store (full refresh) + ingestion report.

    Each source is written on its own, so the report has its seconds and rows per second.
    """
    p = _paths(out)
    files = bronze.trip_file_paths(spark, raw_dir, service)
    trips = bronze.scan_trip_files(spark, files, row_index_col="_fila", size_col="_bytes", path_col="_ruta")
    trips = first_rows_per_source(trips, sample).drop("_fila")
    docs = bronze.to_documents(trips, extra_exclude=["_bytes", "_ruta"])
    began, seconds = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), {}
    for i, source in enumerate(sorted({_source_of(f, service) for f in files})):
        t0 = time.time()
        part = docs.where(F.col("_ingesta.fichero_origen") == source)
        bronze.write_documents(part, p["bronze"], full_refresh=i == 0)
        seconds[source] = time.time() - t0
    stored = bronze.read_documents(spark, p["bronze"])
    per_file = []
    for r in reports.ingest_report(trips, stored, size_col="_bytes").collect():  # one row per source
        took = seconds[r["fichero"]]
        per_file.append({**r.asDict(), "segundos": round(took, 1), "registros_por_segundo": round(r["registros_insertados"] / max(took, 1e-9), 1)})
    inserted, total = sum(r["registros_insertados"] for r in per_file), sum(seconds.values())
    size = reports.storage_sizes(spark.read.parquet(p["bronze"])).first()
    report = {
        "inicio": began,
        "ficheros": per_file,
        "tamano_datos_mb": round(size.bytes_datos / 1e6, 1),
        "tamano_almacenado_mb": round(size.bytes_almacenados / 1e6, 1),
        "segundos_totales": round(total, 1),
        "documentos_finales": inserted,
        "registros_por_segundo": round(inserted / max(total, 1e-9), 1),
    }
    write_report(spark, out, "informe_ingesta_bronze", report)
    return report


def _source_of(path: str, service: str) -> str:
    """The monthly source's name in a path, as `bronze.source_name` gives it."""
    return next((x for x in path.split("/") if x.startswith(f"{service}_tripdata_")), path.rsplit("/", 1)[-1])


def run_export(spark: SparkSession, out: str) -> str:
    """Document store → flat export with the payload's schema."""
    p = _paths(out)
    bronze.write_export(bronze.read_documents(spark, p["bronze"]), p["export"])
    return p["export"]


def build_zone_dimension(spark: SparkSession, lookup_csv: str, out: str, centroids: DataFrame | None = None,
                         road_stats: DataFrame | None = None) -> str:
    """Zone lookup ⟕ centroids ⟕ road statistics, keyed by id (03 re-aimed)."""
    path = _paths(out)["dim_zona"]
    lookup = zone_sources.read_zone_lookup_csv(spark, lookup_csv)
    dim = zones.dim_zona(zones.zone_geometry(lookup, centroids), road_stats)
    zone_sources.write_dimension(dim, path)
    return path


def _table_writer(spark: SparkSession):
    def write(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "stage")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return write


def run_silver(spark: SparkSession, out: str, cfg: PipelineConfig = PipelineConfig(), source: str = config.FUENTE_SILVER) -> dict:
    """Documents or export → silver (by date) + quarantine + quality report."""
    p = _paths(out)
    t0 = time.time()
    docs = bronze.read_export(spark, p["export"]) if source == "export" else bronze.read_documents(spark, p["bronze"])
    geometry = spark.read.parquet(p["dim_zona"]).select("id_zona", "sk_zona", "nombre_zona", "distrito",
                                                       "zona_servicio", "lat", "lon")
    frames = silver_plan.build_silver(docs, geometry, cfg.thresholds, materialize=_table_writer(spark))
    silver_plan.write_silver(frames.silver, p["silver"])
    tagged, obs = silver_plan.quality_observation(frames.tagged)
    silver_plan.write_quarantine(tagged.filter(F.col("motivo_rechazo").isNotNull()), p["cuarentena"])
    seconds = time.time() - t0
    # Counted on the written table: a re-run task can't count twice.
    accepted = spark.read.parquet(p["silver"]).count()
    report = json.loads(reports.quality_report_json(obs.get, accepted, cfg.thresholds.as_dict(), seconds))
    write_report(spark, out, QUALITY_REPORT, report)
    return report


def run_gold(spark: SparkSession, out: str, cfg: PipelineConfig = PipelineConfig()) -> dict:
    """Silver → gold star (S13), without marker files (S14), with conformance report and rejects."""
    p = _paths(out)
    silver_df = spark.read.parquet(p["silver"])
    dim_zona = spark.read.parquet(p["dim_zona"])
    _, checks, rejects = gold_plan.build_gold(silver_df, dim_zona, p["gold"], _table_writer(spark), cfg.key_prefix_hex)
    report = {
        "conformidad": [r.asDict() for r in checks.collect()],  # one row per column and check
        "descartes": {name: df.count() for name, df in rejects.items()},
    }
    write_report(spark, out, "informe_conformidad_gold", report)
    return report


def load_gold(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """Typed load: each table read with its declared schema, which must match exactly."""
    root = _paths(out)["gold"]
    tables = {}
    for name, schema in schemas.GOLD.items():
        df = spark.read.schema(schema).parquet(f"{root}/{name}")
        stored = spark.read.parquet(f"{root}/{name}").schema
        got = [(f.name, f.dataType) for f in stored.fields]
        want = [(f.name, f.dataType) for f in schema.fields]
        if got != want:
            raise TypeError(f"{name}: stored schema {got} differs from the declared {want}")
        tables[name] = df
    return tables


def check_load(spark: SparkSession, out: str, gold: dict[str, DataFrame]) -> dict[str, int]:
    """Loaded rows against what the stages before accepted (S19); raises where they differ.

    The fact against the quality report, zones against the zone dimension, dates and
    operators against silver.
    """
    p = _paths(out)
    silver = spark.read.parquet(p["silver"])
    accepted = read_report(spark, out, QUALITY_REPORT)["registros_aceptados"]
    expected = {
        "fact_servicio": spark.createDataFrame([(accepted,)], "filas_esperadas long"),
        "dim_zona": spark.read.parquet(p["dim_zona"]).agg(F.count(F.lit(1)).alias("filas_esperadas")),
        "dim_tiempo": silver.agg(F.count_distinct("fecha").alias("filas_esperadas")),
        "dim_operador": silver.agg(F.count_distinct("id_operador").alias("filas_esperadas")),
    }
    rows = reports.load_integrity(gold, expected).collect()
    bad = [r.asDict() for r in rows if not (r["ok"] and r["esquema_ok"])]
    if bad:
        raise ValueError(f"loaded tables differ from what was accepted: {bad}")
    return {r["tabla"]: r["filas"] for r in rows}


def run_layouts(spark: SparkSession, out: str, runs: int = 5, params=None) -> dict:
    """Both physical layouts, statistics, equivalence guard and latency report."""
    p = _paths(out)
    params = params or Q.QueryParams()
    t0 = time.time()
    gold = load_gold(spark, out)
    load_s = time.time() - t0
    integrity = check_load(spark, out, gold)
    t0 = time.time()
    fact = layout.compact(spark, gold["fact_servicio"], f"{p['gold']}_ordenado/fact_servicio", ["sk_tiempo", "sk_zona_origen", "sk_servicio"])
    opt = layout.write_optimised(spark, fact)
    optimised_s = time.time() - t0
    t0 = time.time()
    ctl = layout.write_control(spark, gold["fact_servicio"])
    control_s = time.time() - t0
    dims = {}
    for name in ("dim_tiempo", "dim_zona"):
        table = layout.write_dimension_table(spark, gold[name], name)
        layout.analyze(spark, table)
        dims[name] = spark.table(table)
    for t in (opt, ctl):
        layout.analyze(spark, t)
    lay = {layout.OPTIMISED: spark.table(opt), layout.CONTROL: spark.table(ctl)}
    eq = layout.layout_equivalence(lay[layout.OPTIMISED], lay[layout.CONTROL]).collect()[0].asDict()
    if not eq["equivalente"]:
        raise ValueError(f"layouts differ: {eq}")
    t, z = dims["dim_tiempo"], dims["dim_zona"]
    qs = {
        "Q1": lambda f: Q.q1_monthly_overview(f, t),
        "Q2": lambda f: Q.q2_unreliable_corridors(f, z, params),
        "Q3": lambda f: Q.q3_band_degradation(f, t),
        "Q4": lambda f: Q.q4_route_efficiency(f, z, params),
        "Q5": lambda f: Q.q5_date_range(f, t, z, params),
    }
    lat = [r.asDict() for r in layout.measure_latency(spark, qs, lay, runs=runs).collect()]
    report = {"filas": integrity, "carga_s": round(load_s, 1), "optimizada_s": round(optimised_s, 1), "control_s": round(control_s, 1),
              "equivalencia": eq, "latencia": lat, "repeticiones": runs}
    write_report(spark, out, "resultados_layouts", report)
    for name in (opt, ctl):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return report


def _read_table(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A small input table given as Parquet or CSV (with header)."""
    if not path:
        return None
    if path.lower().endswith(".csv"):
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.parquet(path)


def main(argv: list[str] | None = None) -> None:
    from datetime import date

    from ..operators import roads

    ap = argparse.ArgumentParser(prog="viaduct")
    ap.add_argument("stage", choices=["bronze", "export", "zones", "silver", "gold", "layouts", "all"])
    ap.add_argument("--raw", help="folder with {service}_tripdata_YYYY-MM.parquet files")
    ap.add_argument("--service", default=config.TIPO_SERVICIO)
    ap.add_argument("--zones", help="zone lookup CSV")
    ap.add_argument("--centroids", help="zone centroids (LocationID, lat, lon), Parquet or CSV")
    ap.add_argument("--road-edges", help="road edges (id_zona, longitud_m)")
    ap.add_argument("--road-nodes", help="road nodes (id_zona, id_nodo)")
    ap.add_argument("--zone-areas", help="zone areas (id_zona, area)")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--sample", type=int, default=None, help="first N rows of each source")
    ap.add_argument("--silver-source", choices=["documents", "export"], default=config.FUENTE_SILVER)
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="initial shuffle partitions (default: the cluster's setting)")
    ap.add_argument("--q2-min", type=int, default=config.Q2_MIN_SERVICIOS)
    ap.add_argument("--q4-min", type=int, default=config.Q4_MIN_SERVICIOS)
    ap.add_argument("--q5-from", default=config.Q5_DESDE.isoformat())
    ap.add_argument("--q5-to", default=config.Q5_HASTA.isoformat())
    ap.add_argument("--runs", type=int, default=5)
    a = ap.parse_args(argv)
    spark = build_session(a.master, shuffle_partitions=a.shuffle_partitions)
    if a.stage in ("bronze", "all"):
        print(json.dumps(run_bronze(spark, a.raw, a.out, service=a.service, sample=a.sample), default=str))
    if a.stage in ("export", "all"):
        print(run_export(spark, a.out))
    if a.stage in ("zones", "all"):
        road = None
        edges, nodes = _read_table(spark, a.road_edges), _read_table(spark, a.road_nodes)
        if edges is not None and nodes is not None:
            road = roads.road_stats(edges, nodes, _read_table(spark, a.zone_areas))
        print(build_zone_dimension(spark, a.zones, a.out, _read_table(spark, a.centroids), road))
    if a.stage in ("silver", "all"):
        print(json.dumps(run_silver(spark, a.out, source=a.silver_source)))
    if a.stage in ("gold", "all"):
        print(json.dumps(run_gold(spark, a.out), default=str))
    if a.stage in ("layouts", "all"):
        params = Q.QueryParams(a.q2_min, a.q4_min, date.fromisoformat(a.q5_from), date.fromisoformat(a.q5_to))
        print(json.dumps(run_layouts(spark, a.out, runs=a.runs, params=params), default=str))


if __name__ == "__main__":
    main()

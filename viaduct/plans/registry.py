"""Registered queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the fixture adapter and runs
the real operators over the whole tables. Outputs use plain types for
cross-engine comparison: dates and timestamps as text, decimals as doubles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import metrics
from ..functions.projection import STATE_PLANE_2263
from ..operators import conform as conform_ops
from ..operators import geometry, quantiles, roads, sampling, zones
from ..operators.corridor import CORRIDOR_KEYS, add_calendar
from ..operators.flatten import flatten_documents
from ..session import scratch_path
from ..sources import bronze, fixture, reingest
from ..sources import zones as zone_sources
from . import gold as gold_plan
from . import layout
from . import queries as Q
from . import indexes, reports, sql_text, statistics
from . import silver as silver_plan
from .warehouse import Warehouse, warehouse_for

# Rows kept per source file by the sampling query (a sampling operator: the
# limit is the feature).
SAMPLE_ROWS_PER_FILE = 1000


# Month that the reload query loads again.
RELOADED_MONTH = 199802
# Square kilometres of a square US survey foot.
KM2_PER_SQUARE_FOOT = (1200 / 3937 / 1000) ** 2


def for_compare(df: DataFrame) -> DataFrame:
    """Dates → ``yyyy-MM-dd``, timestamps → ``yyyy-MM-dd HH:mm:ss``, decimals → double."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Raw integer fields that may be NULL before the quality rules. Both engines
# hold the same values, but a nullable integer column converts to pandas as
# float64 in one and as a nullable Int32 in the other; comparison views
# expose these fields as doubles in both.
RAW_NULLABLE_INTS = (
    "VendorID", "passenger_count", "PULocationID", "DOLocationID",
    "id_operador", "n_pasajeros", "id_zona_origen", "id_zona_destino",
)


def raw_ints_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in RAW_NULLABLE_INTS if c in df.columns})


def _w(spark: SparkSession, sf_dir: str) -> Warehouse:
    return warehouse_for(spark, sf_dir)


FLAT_COLUMNS = [
    "id_operador", "ts_inicio", "ts_fin", "distancia_millas", "id_zona_origen", "id_zona_destino",
    "n_pasajeros", "importe_total", "hash_registro", "fichero_origen",
]
METRIC_COLUMNS = ["distancia_km", "duracion_min", "velocidad_kmh"]


# -- bronze -----------------------------------------------------------------
def bronze_documents(spark, sf_dir):
    docs = _w(spark, sf_dir).documents
    return raw_ints_as_double(
        docs.select(
            "payload.*",
            F.col("_ingesta.fichero_origen").alias("fichero_origen"),
            F.col("_ingesta.hash_registro").alias("hash_registro"),
            F.col("_ingesta.version_esquema").alias("version_esquema"),
        )
    )


def bronze_export_roundtrip(spark, sf_dir):
    docs = _w(spark, sf_dir).documents
    rebuilt = bronze.nest_export(bronze.export_flat(docs), docs.schema["payload"].dataType)
    return raw_ints_as_double(for_compare(flatten_documents(rebuilt)))


def bronze_sample_per_file(spark, sf_dir):
    docs = _w(spark, sf_dir).documents
    keyed = docs.select(
        F.col("_ingesta.fichero_origen").alias("fichero_origen"),
        F.col("_ingesta.hash_registro").alias("hash_registro"),
        F.col("payload.o_orderkey").alias("o_orderkey"),
        F.col("payload.VendorID").alias("VendorID"),
    )
    # file order of the fixture = (order key, line number, hash)
    return sampling.first_rows_per_group(
        keyed, "fichero_origen", ["o_orderkey", "VendorID", "hash_registro"], SAMPLE_ROWS_PER_FILE
    )


def bronze_sample_by_row_index(spark, sf_dir):
    """First rows of each source by their place in its files, the variant of the runner: sources written in order as part files, scanned again."""
    flat = bronze.export_flat(_w(spark, sf_dir).documents)
    raw = scratch_path(spark, "raw")
    order = ["o_orderkey", "VendorID", "_hash_registro"]
    for i, name in enumerate((fixture.FILE_MAIN, fixture.FILE_COPY), 1):
        # as many part files as the rows need
        one = flat.where(F.col("_fichero_origen") == name).repartitionByRange(*order).sortWithinPartitions(*order)
        one.write.parquet(f"{raw}/yellow_tripdata_2023-{i:02d}.parquet")
    scanned = bronze.scan_trip_files(spark, bronze.trip_file_paths(spark, raw), row_index_col="_fila", path_col="_ruta")
    first = sampling.first_rows_per_source(scanned, SAMPLE_ROWS_PER_FILE)
    return first.select(F.col("_fichero_origen").alias("fichero_origen"), F.col("_hash_registro").alias("hash_registro"), "o_orderkey", "VendorID")


def ingest_report(spark, sf_dir):
    w = _w(spark, sf_dir)
    return reports.ingest_report(w.trips, w.documents)


# -- silver -----------------------------------------------------------------
def storage_report(spark, sf_dir):
    """The bronze store's rows and sizes: stored bytes as the files have them, and less than the rows take as text."""
    size = reports.storage_sizes(_w(spark, sf_dir).documents)
    return size.select(
        "filas", (F.col("archivos") > 0).alias("hay_archivos"), (F.col("bytes_almacenados") > 0).alias("hay_bytes"),
        (F.col("bytes_almacenados") < F.col("bytes_datos")).alias("comprimido"),
    )


def silver_metrics(spark, sf_dir):
    tagged = _w(spark, sf_dir).silver_frames.tagged
    return tagged.select("hash_registro", "fichero_origen", *METRIC_COLUMNS)


def quality_flags(spark, sf_dir):
    return _w(spark, sf_dir).silver_frames.tagged.select("hash_registro", "fichero_origen", "motivo_rechazo")


def quarantine(spark, sf_dir):
    return raw_ints_as_double(for_compare(_w(spark, sf_dir).silver_frames.quarantine))


def accepted_dedup(spark, sf_dir):
    return for_compare(_w(spark, sf_dir).silver_frames.clean.select(*FLAT_COLUMNS, *METRIC_COLUMNS))


def quality_report(spark, sf_dir):
    sf = _w(spark, sf_dir).silver_frames
    return reports.quality_report(sf.tagged, sf.clean)


def corridor_stats(spark, sf_dir):
    return _w(spark, sf_dir).silver_frames.corridors


def silver_eta_deviation(spark, sf_dir):
    s = _w(spark, sf_dir).silver
    return for_compare(
        s.select(
            "hash_registro", "fecha", "hora", "dia_semana", "es_laborable", "franja_horaria",
            "eta_referencia_min", "n_servicios_corredor", "fiabilidad_corredor", "desviacion_eta_pct",
        )
    )


def silver_detour(spark, sf_dir):
    s = _w(spark, sf_dir).silver
    return s.select(
        "hash_registro",
        "sk_zona_origen",
        "sk_zona_destino",
        F.round("distancia_geodesica_km", 6).alias("distancia_geodesica_km"),
        F.round("factor_rodeo", 6).alias("factor_rodeo"),
    )


def zone_road_stats(spark, sf_dir):
    return for_compare(_w(spark, sf_dir).road_stats)


# -- exact quantiles, zone geometry, road graph --------------------------------
def corridor_stats_exact(spark, sf_dir):
    """Corridor reference times as exact quantiles, whatever a corridor's size."""
    trips = add_calendar(_w(spark, sf_dir).silver_frames.clean.select("id_zona_origen", "id_zona_destino", "ts_inicio", "duracion_min"))
    q = quantiles.exact_quantiles(trips, CORRIDOR_KEYS, "duracion_min", {"eta_referencia_min": (1, 2), "p90_min": (9, 10)}, "n_servicios_corredor")
    return q.withColumn("fiabilidad_corredor", metrics.guarded_ratio(F.col("p90_min"), F.col("eta_referencia_min")))


def operator_quantiles_exact(spark, sf_dir):
    """Amounts of each operator, one of few large groups."""
    trips = _w(spark, sf_dir).silver_frames.clean.select("id_operador", "importe_total")
    q = {"p01": (1, 100), "p50": (1, 2), "p90": (9, 10), "p99": (99, 100), "maximo": (1, 1)}
    return quantiles.exact_quantiles(trips, ["id_operador"], "importe_total", q, "n_servicios")


def zone_polygon_centroids(spark, sf_dir):
    """Area and centroid of the zone polygons, in map units and in degrees."""
    c = geometry.centroids(geometry.ring_edges(fixture.fixture_zone_vertices(spark, sf_dir)))
    lon, lat = STATE_PLANE_2263.inverse(F.col("x"), F.col("y"))
    return c.select(
        "id_zona", F.round("area", 3).alias("area"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round(lat, 9).alias("lat"),
        F.round(lon, 9).alias("lon"),
    )


def projection_roundtrip(spark, sf_dir):
    """Road nodes to degrees and back to map units."""
    nodes = fixture.fixture_road_graph(spark, sf_dir)[1]
    lon, lat = STATE_PLANE_2263.inverse(F.col("x"), F.col("y"))
    degrees = nodes.select("id_nodo", "x", "y", lon.alias("lon"), lat.alias("lat"))
    x, y = STATE_PLANE_2263.forward(F.col("lon"), F.col("lat"))
    return degrees.select(
        "id_nodo", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"), F.round(x, 3).alias("x"), F.round(y, 3).alias("y"),
        ((F.abs(x - F.col("x")) < 1e-4) & (F.abs(y - F.col("y")) < 1e-4)).alias("vuelve"),
    )


def nodes_in_zones(spark, sf_dir):
    return _w(spark, sf_dir).located_nodes.select("id_nodo", F.col("id_zona").cast("double").alias("id_zona"))


def road_graph_simplified(spark, sf_dir):
    return for_compare(_w(spark, sf_dir).simplified_roads)


def zone_road_graph_stats(spark, sf_dir):
    """Road statistics of each zone's own simplified graph."""
    w = _w(spark, sf_dir)
    areas = geometry.centroids(w.zone_edges).select("id_zona", (F.col("area") * KM2_PER_SQUARE_FOOT).alias("area"))
    return for_compare(roads.graph_stats(w.simplified_roads, areas))


# -- gold -------------------------------------------------------------------
def gold_dim_tiempo(spark, sf_dir):
    return for_compare(_w(spark, sf_dir).gold_dim_tiempo)


def gold_dim_operador(spark, sf_dir):
    return for_compare(_w(spark, sf_dir).gold_dim_operador)


def gold_dim_zona(spark, sf_dir):
    return for_compare(_w(spark, sf_dir).gold_dim_zona)


def gold_fact_servicio(spark, sf_dir):
    return for_compare(_w(spark, sf_dir).gold_fact)


def conformance_report(spark, sf_dir):
    return gold_plan.conformance_report(_w(spark, sf_dir).gold_raw)


def gold_rejects(spark, sf_dir):
    """Source rows of the fact of which the gold types hold not every value.

    The trips all fit, so some get amounts, passengers and dates that don't: every 500th, 700th and 900th.
    """
    every = lambda n: F.col("sk_servicio") % n == 0
    odd = _w(spark, sf_dir).fact_rows.withColumns({
        "importe_total": F.when(every(500), F.col("importe_total") * 1e8).otherwise(F.col("importe_total")),
        "n_pasajeros": F.when(every(700), 100_000).otherwise(F.col("n_pasajeros")),
        "sk_tiempo": F.when(~every(900), F.col("sk_tiempo")),
    })
    rejects = conform_ops.conform(odd, schemas.FACT_SERVICIO).rejects
    return rejects.select("hash_registro", F.array_join(conform_ops.REASON, ",").alias(conform_ops.REASON))


def load_integrity(spark, sf_dir):
    w = _w(spark, sf_dir)
    one = lambda df: df.agg(F.count(F.lit(1)).alias("filas_esperadas"))
    accepted = w.silver_frames.clean
    expected = {
        # the de-duplicated stage table holds one row per distinct accepted record
        "fact_servicio": one(accepted),
        "dim_zona": one(w.zone_lookup),
        "dim_tiempo": w.silver.agg(F.count_distinct("fecha").alias("filas_esperadas")),
        "dim_operador": w.silver.agg(F.count_distinct("id_operador").alias("filas_esperadas")),
    }
    return reports.load_integrity(w.gold.as_dict(), expected)


# -- reference queries ------------------------------------------------------
def q1_monthly_overview(spark, sf_dir):
    w = _w(spark, sf_dir)
    return Q.q1_monthly_overview(w.gold_fact, w.gold_dim_tiempo)


def q2_unreliable_corridors(spark, sf_dir):
    w = _w(spark, sf_dir)
    return Q.q2_unreliable_corridors(w.gold_fact, w.gold_dim_zona, w.params)


def q3_band_degradation(spark, sf_dir):
    w = _w(spark, sf_dir)
    return Q.q3_band_degradation(w.gold_fact, w.gold_dim_tiempo)


def q4_route_efficiency(spark, sf_dir):
    w = _w(spark, sf_dir)
    return Q.q4_route_efficiency(w.gold_fact, w.gold_dim_zona, w.params)


def q5_date_range(spark, sf_dir):
    w = _w(spark, sf_dir)
    return for_compare(Q.q5_date_range(w.gold_fact, w.gold_dim_tiempo, w.gold_dim_zona, w.params))


def reference_queries(w: Warehouse, dims: dict[str, DataFrame]) -> dict[str, Callable[[DataFrame], DataFrame]]:
    t, z, p = dims["dim_tiempo"], dims["dim_zona"], w.params
    return {
        "Q1": lambda f: Q.q1_monthly_overview(f, t),
        "Q2": lambda f: Q.q2_unreliable_corridors(f, z, p),
        "Q3": lambda f: Q.q3_band_degradation(f, t),
        "Q4": lambda f: Q.q4_route_efficiency(f, z, p),
        "Q5": lambda f: Q.q5_date_range(f, t, z, p),
    }


# -- layouts ----------------------------------------------------------------
def layout_equivalence(spark, sf_dir):
    lay = _w(spark, sf_dir).layouts
    return layout.layout_equivalence(lay[layout.OPTIMISED], lay[layout.CONTROL])


def layout_results(spark, sf_dir):
    w = _w(spark, sf_dir)
    return layout.layout_results(reference_queries(w, w.dimension_tables), w.layouts)


# -- sources and sinks: written, read back -------------------------------------
def bronze_monthly_scan(spark, sf_dir):
    """Trips written as monthly files of differing columns and types, scanned into documents."""
    trips = _w(spark, sf_dir).trips.drop("fichero_origen")
    raw = scratch_path(spark, "raw")
    month = F.pmod("o_orderkey", F.lit(3))
    layouts = (
        trips.where(month == 0),
        trips.where(month == 1).withColumn("passenger_count", F.col("passenger_count").cast("double")),
        trips.where(month == 2).withColumn("nota", F.concat_ws("|", F.lit("n=1"), F.col("VendorID").cast("string"))),
    )
    for i, df in enumerate(layouts, 1):
        df.write.parquet(f"{raw}/yellow_tripdata_2023-{i:02d}.parquet")
    files = bronze.trip_file_paths(spark, raw)
    docs = bronze.to_documents(bronze.scan_trip_files(spark, files))
    flat = flatten_documents(docs).select("hash_registro", "fichero_origen", "n_pasajeros", "distancia_millas")
    return flat.withColumn("n_pasajeros", F.col("n_pasajeros").cast("double"))


def zone_csv_roundtrip(spark, sf_dir):
    """Zone lookup through the CSV format and the dimension sink."""
    path = scratch_path(spark, "zones")
    _w(spark, sf_dir).zone_lookup.write.option("header", True).csv(f"{path}/lookup.csv")
    lookup = zone_sources.read_zone_lookup_csv(spark, f"{path}/lookup.csv")
    zone_sources.write_dimension(zones.zone_geometry(lookup), f"{path}/dim")
    return zone_sources.read_dimension(spark, f"{path}/dim").select("sk_zona", "id_zona", "nombre_zona", "distrito", "zona_servicio")


def silver_by_date(spark, sf_dir):
    """Silver written by date and read back: rows and distance of each month."""
    path = scratch_path(spark, "silver_by_date")
    silver_plan.write_silver(_w(spark, sf_dir).silver, path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.date_format("fecha", "yyyy-MM").alias("mes")).agg(
        F.count(F.lit(1)).alias("filas"), F.sum(F.round(F.col("distancia_km") * 1000).cast("long")).alias("metros")
    )


def fact_compacted(spark, sf_dir):
    """The fact re-sorted and analysed (S17, S18): rows and key span of each date, and the catalog's row count."""
    w = _w(spark, sf_dir)
    path = scratch_path(spark, "compact")
    df = layout.compact(spark, w.gold_fact, path, ["sk_tiempo", "sk_zona_origen", "sk_servicio"])
    rows = layout.catalog_rows(spark, layout.analysed_table(spark, path, "fact_compacted"))
    return df.groupBy("sk_tiempo").agg(
        F.count(F.lit(1)).alias("filas"), F.min("sk_servicio").alias("primero"), F.max("sk_servicio").alias("ultimo")
    ).withColumn("filas_catalogo", F.lit(rows).cast("long"))


# -- loads after the first one ---------------------------------------------------
def bronze_reingest(spark, sf_dir):
    """Three overlapping loads of the trips: each stored record with the load that brought it."""
    docs = _w(spark, sf_dir).documents
    first = F.col("_ingesta.fichero_origen") == fixture.FILE_MAIN
    path = scratch_path(spark, "reingest")
    for load in (docs.where(first & (F.col("payload.o_orderkey") % 3 != 0)), docs.where(first), docs):
        reingest.load_new(load, path, least_rows=1000, stored_rows=True)
    return reingest.read_store(spark, path).select(
        F.col("_ingesta.hash_registro").alias("hash_registro"), F.col("_ingesta.fichero_origen").alias("fichero_origen"), F.col("carga").cast("int").alias("carga")
    )


def month_reload(spark, sf_dir):
    """The fact by month, one month of it loaded again without its night trips: rows and amounts of each month."""
    w = _w(spark, sf_dir)
    path = scratch_path(spark, "by_month")
    rows = layout.with_month(w.gold_fact, w.gold_dim_tiempo)
    layout.write_by_month(rows, path)
    layout.reload_months(rows.where((F.col(layout.MONTH) == RELOADED_MONTH) & (F.col("hora") < 20)), path)
    return spark.read.parquet(path).groupBy(layout.MONTH).agg(
        F.count(F.lit(1)).alias("filas"), F.sum(F.col("importe_total").cast("decimal(20,2)")).cast("double").alias("importe")
    )


def q5_by_month(spark, sf_dir):
    """Q5 over the layout by month."""
    w = _w(spark, sf_dir)
    path = scratch_path(spark, "by_month")
    layout.write_by_month(layout.with_month(w.gold_fact, w.gold_dim_tiempo), path)
    return for_compare(Q.q5_by_month(spark.read.parquet(path), w.gold_dim_tiempo, w.gold_dim_zona, w.params))


def sql_text_results(spark, sf_dir):
    """The reference queries as SQL text, on both layouts: rows, and whether they equal the DataFrame form."""
    w = _w(spark, sf_dir)
    tables = {n: sql_text.registered(df, n) for n, df in w.dimension_tables.items()}
    frames, texts = reference_queries(w, w.dimension_tables), sql_text.reference_sql()
    out = None
    for name, df in w.layouts.items():
        fact = sql_text.registered(df, "fact")
        for q, text in texts.items():
            both = layout.layout_equivalence(sql_text.run(spark, text, {**tables, "fact": fact}, w.params), frames[q](df))
            row = both.select(F.lit(q).alias("consulta"), F.lit(name).alias("layout"), F.col("n_optimizada").alias("filas"), F.col("equivalente").alias("iguales"))
            out = row if out is None else out.unionByName(row)
    return out


# -- indexes and statistics of the stored tables -----------------------------------
def hash_lookup(spark, sf_dir):
    """Trips of every hash that begins with two zeros, through the layout by hash; and whether only files of that range were read."""
    flat = _w(spark, sf_dir).silver_frames.clean.select("hash_registro", "id_operador", "importe_total")
    path = scratch_path(spark, "by_hash")
    indexes.write_hash_indexed(flat, path, "hash_registro", rows_per_file=500)
    index = indexes.file_ranges(spark, path, "hash_registro")
    keys = flat.where("hash_registro < '01'").select("hash_registro")
    rows, read = indexes.lookup(spark, path, index, keys, "hash_registro")
    within = indexes.files_in_range(index, 0, "00", "01")
    return rows.withColumn("solo_su_rango", F.lit(0 < read <= within < index.count()))


def interleaved_layout(spark, sf_dir):
    """Ranges of the operator and of the date, on a layout sorted by date and operator and on one by interleaved bits: rows, and whether files are skipped."""
    fact = _w(spark, sf_dir).gold_fact
    ranges = {"sk_operador": (3, 3), "sk_tiempo": (500, 600)}
    out = []
    for layout_name in ("ordenado", "intercalado"):
        path = scratch_path(spark, layout_name)
        if layout_name == "ordenado":
            fact.repartitionByRange(64, "sk_tiempo", "sk_operador", "sk_servicio").sortWithinPartitions("sk_tiempo", "sk_operador").write.parquet(path)
        else:
            indexes.write_interleaved(fact, path, "sk_operador", "sk_tiempo", "sk_servicio", partitions=64)
        index = indexes.file_ranges(spark, path, *ranges)
        for i, (c, (low, high)) in enumerate(ranges.items()):
            rows = spark.read.parquet(path).where(F.col(c).between(low, high)).agg(F.count(F.lit(1)).alias("filas"))
            skips = 2 * indexes.files_in_range(index, i, low, high) <= index.count()
            out.append(rows.select(F.lit(layout_name).alias("disposicion"), F.lit(c).alias("columna"), "filas", F.lit(skips).alias("salta_la_mitad")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def plan_estimates(spark, sf_dir):
    """Filters and joins of the fact: their rows, and whether the cost-based estimate is within a factor of two."""
    w = _w(spark, sf_dir)
    path = scratch_path(spark, "estimates")
    w.gold_fact.write.parquet(path)
    fact = layout.analysed_table(spark, path, "fact_estimates")
    statistics.analyze_with_histograms(spark, fact)
    zones_ = layout.write_dimension_table(spark, w.gold_dim_zona, "dim_zona_estimates")
    statistics.analyze_with_histograms(spark, zones_)
    f, z = spark.table(fact), spark.table(zones_)
    frames = {
        "duracion": f.where("duracion_min < 30"), "fecha": f.where("sk_tiempo BETWEEN 500 AND 600"), "importe": f.where("importe_total > 50000"),
        "operador": f.where("sk_operador = 3"), "zona": f.join(z, f.sk_zona_origen == z.sk_zona),
    }
    out = None
    for name, df in frames.items():
        guess = statistics.estimated_rows(df)
        n = F.count(F.lit(1))
        near = (F.lit(guess) <= 2 * n + 10) & (n <= 2 * F.lit(guess) + 10) if guess is not None else F.lit(False)
        row = df.agg(n.alias("filas"), near.alias("estimado")).select(F.lit(name).alias("consulta"), "filas", "estimado")
        out = row if out is None else out.unionByName(row)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_documents": bronze_documents,
    "bronze_export_roundtrip": bronze_export_roundtrip,
    "bronze_sample_per_file": bronze_sample_per_file,
    "bronze_sample_by_row_index": bronze_sample_by_row_index,
    "ingest_report": ingest_report,
    "storage_report": storage_report,
    "silver_metrics": silver_metrics,
    "quality_flags": quality_flags,
    "quarantine": quarantine,
    "accepted_dedup": accepted_dedup,
    "quality_report": quality_report,
    "corridor_stats": corridor_stats,
    "silver_eta_deviation": silver_eta_deviation,
    "silver_detour": silver_detour,
    "zone_road_stats": zone_road_stats,
    "corridor_stats_exact": corridor_stats_exact,
    "operator_quantiles_exact": operator_quantiles_exact,
    "zone_polygon_centroids": zone_polygon_centroids,
    "projection_roundtrip": projection_roundtrip,
    "nodes_in_zones": nodes_in_zones,
    "road_graph_simplified": road_graph_simplified,
    "zone_road_graph_stats": zone_road_graph_stats,
    "gold_dim_tiempo": gold_dim_tiempo,
    "gold_dim_operador": gold_dim_operador,
    "gold_dim_zona": gold_dim_zona,
    "gold_fact_servicio": gold_fact_servicio,
    "conformance_report": conformance_report,
    "load_integrity": load_integrity,
    "q1_monthly_overview": q1_monthly_overview,
    "q2_unreliable_corridors": q2_unreliable_corridors,
    "q3_band_degradation": q3_band_degradation,
    "q4_route_efficiency": q4_route_efficiency,
    "q5_date_range": q5_date_range,
    "layout_equivalence": layout_equivalence,
    "layout_results": layout_results,
    "gold_rejects": gold_rejects,
    "bronze_monthly_scan": bronze_monthly_scan,
    "zone_csv_roundtrip": zone_csv_roundtrip,
    "silver_by_date": silver_by_date,
    "fact_compacted": fact_compacted,
    "bronze_reingest": bronze_reingest,
    "month_reload": month_reload,
    "q5_by_month": q5_by_month,
    "sql_text_results": sql_text_results,
    "hash_lookup": hash_lookup,
    "interleaved_layout": interleaved_layout,
    "plan_estimates": plan_estimates,
}

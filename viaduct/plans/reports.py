"""Run reports: ingestion (A5), quality (A3, A4, O1) and load integrity."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..operators.quality import MOTIVO


def ingest_report(
    source: DataFrame, documents: DataFrame, file_col: str = "fichero_origen", size_col: str | None = None
) -> DataFrame:
    """Per source file: rows read, documents stored, and whether they agree.

    With ``size_col`` the file size comes from the same aggregation.
    """
    extra = [F.max(size_col).alias("bytes")] if size_col else []
    src = source.groupBy(F.col(file_col).alias("fichero")).agg(
        F.count(F.lit(1)).alias("registros_origen"), *extra
    )
    ins = documents.groupBy(F.col("_ingesta.fichero_origen").alias("fichero")).agg(
        F.count(F.lit(1)).alias("registros_insertados")
    )
    return (
        src.join(ins, "fichero", "full")
        .select(
            "fichero",
            F.coalesce("registros_origen", F.lit(0)).alias("registros_origen"),
            F.coalesce("registros_insertados", F.lit(0)).alias("registros_insertados"),
            *(["bytes"] if size_col else []),
        )
        .withColumn("coincide", F.col("registros_origen") == F.col("registros_insertados"))
        .orderBy("fichero")
    )


def storage_sizes(stored: DataFrame) -> DataFrame:
    """One row of a written table: filas, archivos, bytes_datos (its rows as JSON text), bytes_almacenados (its files).

    File sizes come with the scan (one row per file after the aggregation); files without rows aren't seen.
    """
    text = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in stored.columns])))
    files = stored.groupBy(F.col("_metadata.file_path").alias("archivo")).agg(
        F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("filas"), F.sum(text.cast("long")).alias("datos")
    )
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    return files.agg(total("filas", "filas"), F.count(F.lit(1)).alias("archivos"), total("datos", "bytes_datos"), total("bytes", "bytes_almacenados"))


def quality_report(tagged: DataFrame, clean: DataFrame | None = None, key: str = "hash_registro") -> DataFrame:
    """Rejections per rule, in descending order, with the run totals.

    Per-rule row counts are one map-side aggregate over the tagged rows (a
    shuffle of a few rows per task). The number of distinct accepted records
    is the row count of ``clean``, the already de-duplicated stage table, so
    no second shuffle by hash is needed; without it the distinct count comes
    from an aggregate by (rule, hash). Totals are window sums over the few
    rule rows. Duplicates removed from the accepted rows are reported apart,
    not counted as rejected.
    """
    if clean is None:
        per_hash = tagged.groupBy(MOTIVO, key).agg(F.count(F.lit(1)).alias("_c"))
        per_rule = per_hash.groupBy(MOTIVO).agg(
            F.sum("_c").cast("long").alias("_rows"), F.count(F.lit(1)).cast("long").alias("_distinct")
        )
    else:
        rows = tagged.groupBy(MOTIVO).agg(F.count(F.lit(1)).cast("long").alias("_rows")).withColumn(
            "_distinct", F.lit(None).cast("long")
        )
        distinct = clean.agg(F.count(F.lit(1)).cast("long").alias("_distinct")).select(
            F.lit(None).cast("string").alias(MOTIVO), F.lit(None).cast("long").alias("_rows"), "_distinct"
        )
        per_rule = rows.unionByName(distinct).groupBy(MOTIVO).agg(
            F.sum("_rows").alias("_rows"), F.max("_distinct").alias("_distinct")
        )
    everything = Window.partitionBy()
    acc = F.col(MOTIVO).isNull()
    totals = per_rule.select(
        MOTIVO,
        F.col("_rows").alias("n_rechazos"),
        F.sum("_rows").over(everything).alias("registros_entrada"),
        F.coalesce(F.max(F.when(acc, F.col("_distinct"))).over(everything), F.lit(0)).alias("registros_aceptados"),
        F.coalesce(F.max(F.when(acc, F.col("_rows") - F.col("_distinct"))).over(everything), F.lit(0)).alias(
            "registros_duplicados"
        ),
        F.sum(F.when(~acc, F.col("_rows"))).over(everything).alias("registros_rechazados"),
    )
    pct = lambda n: F.round(F.col(n).cast("double") * 100 / F.col("registros_entrada"), 3)
    return (
        totals.filter(~acc)
        .withColumn("pct_entrada", pct("n_rechazos"))
        .withColumn("tasa_rechazo_pct", pct("registros_rechazados"))
        .select(
            MOTIVO, "n_rechazos", "pct_entrada", "registros_entrada", "registros_aceptados", "registros_duplicados",
            "registros_rechazados", "tasa_rechazo_pct",
        )
        .orderBy(F.col("n_rechazos").desc(), MOTIVO)
    )


def quality_report_json(metrics: dict, accepted_distinct: int, thresholds: dict, seconds: float) -> str:
    """Nested JSON report from observed counts (no extra pass over the data)."""
    total = int(metrics["registros_entrada"])
    acc_with_copies = int(metrics["aceptados_con_copias"])
    rejected = total - acc_with_copies
    rules = {k: int(v) for k, v in metrics.items() if k.startswith("R") and int(v) > 0}
    return json.dumps(
        {
            "registros_entrada": total,
            "registros_aceptados": accepted_distinct,
            "registros_duplicados": acc_with_copies - accepted_distinct,
            "registros_rechazados": rejected,
            "tasa_rechazo_pct": round(rejected / total * 100, 3) if total else 0,
            "rechazos_por_regla": dict(sorted(rules.items(), key=lambda kv: (-kv[1], kv[0]))),
            "umbrales": thresholds,
            "segundos_pipeline": round(seconds, 1),
        },
        indent=2,
        ensure_ascii=False,
    )


def load_integrity(gold: dict[str, DataFrame], expected: dict[str, DataFrame]) -> DataFrame:
    """Loaded rows per gold table against the expected count, and schema match.

    ``expected[name]`` is a one-row frame with column ``filas_esperadas``.
    Counts are stacked as (tabla, medida, n) rows and folded per table.
    """
    parts = []
    schema_ok = {}
    for name, df in gold.items():
        declared = schemas.GOLD[name]
        schema_ok[name] = [(f.name, f.dataType) for f in df.schema.fields] == [
            (f.name, f.dataType) for f in declared.fields
        ]
        parts.append(df.agg(F.count(F.lit(1)).cast("long").alias("n")).select(
            F.lit(name).alias("tabla"), F.lit("filas").alias("medida"), "n"))
        parts.append(expected[name].select(
            F.lit(name).alias("tabla"), F.lit("filas_esperadas").alias("medida"),
            F.col("filas_esperadas").cast("long").alias("n")))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    ok_map = F.create_map(*[x for k, v in schema_ok.items() for x in (F.lit(k), F.lit(v))])
    return (
        stacked.groupBy("tabla")
        .agg(
            F.max(F.when(F.col("medida") == "filas", F.col("n"))).alias("filas"),
            F.max(F.when(F.col("medida") == "filas_esperadas", F.col("n"))).alias("filas_esperadas"),
        )
        .select(
            "tabla",
            "filas",
            "filas_esperadas",
            (F.col("filas") == F.col("filas_esperadas")).alias("ok"),
            ok_map[F.col("tabla")].alias("esquema_ok"),
        )
    )

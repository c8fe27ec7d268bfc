"""Fit a frame to a fixed table schema and report what doesn't fit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REASON = "columnas_sin_encaje"


@dataclass
class Conformed:
    """``rows`` in the table's schema, and the source rows of which a value was lost or a required one is missing."""

    rows: DataFrame
    rejects: DataFrame


class SchemaMismatch(ValueError):
    """A required column is missing, or rows break NOT NULL or a key."""


def _misfit(field: T.StructField) -> Column:
    """The column's name where its value doesn't survive the declared type or a required value is missing."""
    source = F.col(f"`{field.name}`")
    typed = source.try_cast(field.dataType)
    broken = typed.isNull() & (F.lit(not field.nullable) | source.isNotNull())
    return F.when(broken, F.lit(field.name))


def conform(df: DataFrame, schema: T.StructType) -> Conformed:
    """Both halves of ``df`` against ``schema``, each a lazy projection of it.

    ``rows`` has the schema's columns in its order; a value that doesn't fit its
    type (overflow, NaN) is NULL there, a nullable column that ``df`` lacks is
    NULL, and decimals round HALF_UP. ``rejects`` holds the source rows with such values
    and the names of their columns. A missing required column is an error.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    required = [f.name for f in schema.fields if f.name in missing and not f.nullable]
    if required:
        raise SchemaMismatch(f"required columns are missing: {required}")
    given = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name in missing}) if missing else df
    reasons = F.array_compact(F.array(*[_misfit(f) for f in schema.fields]))
    return Conformed(
        rows=given.selectExpr(*[f"try_cast(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]),
        rejects=given.withColumn(REASON, reasons).where(F.size(REASON) > 0),
    )


def conformance_checks(
    df: DataFrame, table: str, schema: T.StructType, varchar_limits: dict[str, int] | None = None
) -> DataFrame:
    """One pass over ``df`` counting, per column, rows that break the schema.

    Checks: ``nulo_en_not_null`` (NULL in a NOT NULL column after the cast),
    ``perdido_en_cast`` (non-NULL value that the cast turned into NULL) and
    ``excede_varchar`` (text longer than the declared length). Returns rows
    (tabla, columna, comprobacion, n_filas).
    """
    varchar_limits = varchar_limits or {}
    present = set(df.columns)
    aggs, labels = [], []
    for f in schema.fields:
        if f.name not in present:
            continue
        src = F.col(f.name)
        cast = src.try_cast(f.dataType)
        if not f.nullable:
            aggs.append(F.count_if(cast.isNull()))
            labels.append((f.name, "nulo_en_not_null"))
        aggs.append(F.count_if(src.isNotNull() & cast.isNull()))
        labels.append((f.name, "perdido_en_cast"))
        if f.name in varchar_limits:
            aggs.append(F.count_if(F.length(cast) > varchar_limits[f.name]))
            labels.append((f.name, "excede_varchar"))
    row = df.agg(*[a.cast("long").alias(f"c{i}") for i, a in enumerate(aggs)])
    stack = ", ".join(f"'{c}', '{k}', c{i}" for i, (c, k) in enumerate(labels))
    return row.selectExpr(f"stack({len(labels)}, {stack}) as (columna, comprobacion, n_filas)").select(
        F.lit(table).alias("tabla"), "columna", "comprobacion", "n_filas"
    )


def duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    """Number of ``key`` values held by more than one row (D2), as one report row."""
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return dup.agg(F.count(F.lit(1)).cast("long").alias("n_filas")).select(
        F.lit(table).alias("tabla"), F.lit(key).alias("columna"), F.lit("clave_duplicada").alias("comprobacion"),
        "n_filas",
    )

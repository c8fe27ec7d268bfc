"""Silver to the gold star schema (dimensions, keys, conformed fact)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import dims
from ..operators.conform import Conformed, SchemaMismatch, conform, conformance_checks, duplicate_keys
from ..operators.keys import dense_hash_key

FACT = "fact_servicio"
# Dimensions are short lists: one file each. The fact keeps its partitions.
FILES = {"dim_zona": 1, "dim_tiempo": 1, "dim_operador": 1, FACT: None}
BREAKS = ("nulo_en_not_null", "clave_duplicada")


@dataclass
class GoldFrames:
    dim_zona: DataFrame
    dim_tiempo: DataFrame
    dim_operador: DataFrame
    fact_servicio: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in FILES}


def fact_with_keys(silver: DataFrame, dim_tiempo: DataFrame, dim_operador: DataFrame, prefix_chars: int = 4) -> DataFrame:
    """Silver trips with a dense trip key and date / operator surrogate keys.

    The trips are numbered first, so the bucket-count pass of the dense key
    reads only the hash column. Both dimensions should be written tables, whose
    size the planner knows.
    """
    return with_dimension_keys(dense_hash_key(silver, "hash_registro", "sk_servicio", prefix_chars), dim_tiempo, dim_operador)


def numbered_trips(trips: DataFrame, prefix_chars: int = 4) -> DataFrame:
    """``trips`` with the dense trip key; the content hash (lower-case hexadecimal) is shuffled as bytes, whose order is that of the text."""
    slim = trips.withColumn("hash_registro", F.unhex("hash_registro"))
    keyed = dense_hash_key(slim, "hash_registro", "sk_servicio", max(1, prefix_chars // 2))
    return keyed.withColumn("hash_registro", F.lower(F.hex("hash_registro")))


def with_dimension_keys(trips: DataFrame, dim_tiempo: DataFrame, dim_operador: DataFrame) -> DataFrame:
    t, o = dim_tiempo.select("fecha", "sk_tiempo"), dim_operador.select("id_operador", "sk_operador")
    return trips.join(t, "fecha", "left").join(o, "id_operador", "left")


def conformed_fact(silver: DataFrame, dim_tiempo: DataFrame, dim_operador: DataFrame, prefix_chars: int = 4) -> DataFrame:
    """The rows of `fact_with_keys` in the fact's schema, for the fact alone.

    Everything but the trip key is fitted before the numbering, so its shuffle holds the fact's own columns in
    their declared types and the content hash (hexadecimal, two digits a byte) as bytes, whose order is that of the text.
    """
    types = {f.name: f.dataType for f in schemas.GOLD[FACT].fields}
    keyed = with_dimension_keys(silver, dim_tiempo, dim_operador)
    slim = keyed.select(F.unhex("hash_registro").alias("_hash"), *[F.col(c).try_cast(types[c]).alias(c) for c in keyed.columns if c in types])
    return conform(dense_hash_key(slim, "_hash", "sk_servicio", max(1, prefix_chars // 2)), schemas.GOLD[FACT]).rows


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """One gold table as Parquet, without marker files; read back."""
    path, files = f"{root.rstrip('/')}/{name}", FILES[name]
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return df.sparkSession.read.parquet(path)


def conformance_report(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows that break each table's schema (D3), and keys held by several rows (D2), the fact's included."""
    parts = [conformance_checks(df, name, schemas.GOLD[name], schemas.VARCHAR_LIMITS.get(name)) for name, df in raw.items()]
    parts += [duplicate_keys(raw[name], name, k) for name, keys in schemas.UNIQUE_KEYS.items() for k in keys]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_gold(
    silver: DataFrame, dim_zona: DataFrame, root: str, materialize: Callable[[DataFrame], DataFrame], prefix_chars: int = 4
) -> tuple[GoldFrames, DataFrame, dict[str, DataFrame]]:
    """(written gold tables, conformance report, rejects of each table).

    The date and operator dimensions are written first and the fact is keyed from the
    written tables, so silver is read once for each of them and once for the
    fact. Rows that lose a value stay in the table with NULL there and are also
    written whole to ``rejects``; rows that break NOT NULL or a key make the run fail.
    """
    raw = {"dim_zona": dim_zona, "dim_tiempo": materialize(dims.dim_tiempo(silver)), "dim_operador": materialize(dims.dim_operador(silver))}
    raw[FACT] = materialize(fact_with_keys(silver, raw["dim_tiempo"], raw["dim_operador"], prefix_chars))
    report = materialize(conformance_report(raw))
    fitted: dict[str, Conformed] = {name: conform(df, schemas.GOLD[name]) for name, df in raw.items()}
    rejects = {}
    for name, half in fitted.items():
        half.rejects.write.mode("overwrite").parquet(f"{root.rstrip('/')}_descartes/{name}")
        rejects[name] = silver.sparkSession.read.schema(half.rejects.schema).parquet(f"{root.rstrip('/')}_descartes/{name}")
    broken = report.where(F.col("comprobacion").isin(*BREAKS) & (F.col("n_filas") > 0)).limit(20).collect()
    if broken:
        raise SchemaMismatch("; ".join(f"{r['tabla']}.{r['columna']}: {r['n_filas']} x {r['comprobacion']}" for r in broken))
    return GoldFrames(**{name: write_table(half.rows, root, name) for name, half in fitted.items()}), report, rejects

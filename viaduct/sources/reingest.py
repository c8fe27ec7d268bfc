"""Re-ingestion detection across loads (the purpose of the content hash, P2).

A store is a folder with ``documentos`` (the bronze documents) and ``filtro`` (a Bloom filter over their hashes),
both in one sub-folder per load, ``carga=1``, ``carga=2`` and so on. A load is over when its filter is written: documents
without a filter are what a broken load left, and the next load replaces them.

The filter has blocks of eight 64-bit words; a hash chooses a block and sets one bit in each word. It is a table
of one row per used block, built by one aggregate that combines in the map tasks, and merged with the last
load's by another. A load joins its hashes with the filter: what misses a bit is new for
certain. Only what is left is compared with the stored hashes themselves, exactly; where nothing is left, the store isn't read.
Whole documents are shuffled only where both the known and the new ones are too many for a broadcast of their hashes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORDS = 8
BLOCK_BITS = 64 * WORDS
# Bits for each stored hash; a filter with fewer is built anew. One hash in some 2,000 is then taken for a known one at first.
BITS = 16
HASH = "_ingesta.hash_registro"
# Hashes that every executor may hold.
BROADCAST_HASHES = 500_000


def _block(hash_: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(hash_), F.lit(blocks))


def _bits(hash_: str) -> list[Column]:
    """One bit for each word, of 48 bits of a second hash."""
    return [F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(xxhash64({hash_}, 1), {6 * i}) & 63 AS int))") for i in range(WORDS)]


def block_filter(hashes: DataFrame, blocks: int) -> DataFrame:
    """bloque, p0 ... p7 of the hashes in column ``h``."""
    return hashes.groupBy(_block(F.col("h"), blocks).alias("bloque")).agg(*[F.bit_or(b).alias(f"p{i}") for i, b in enumerate(_bits("h"))])


def merged(filters: DataFrame) -> DataFrame:
    return filters.groupBy("bloque").agg(*[F.bit_or(f"p{i}").alias(f"p{i}") for i in range(WORDS)])


def maybe_known(hashes: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """The hashes (column ``h``) of which the filter has every bit: all that are stored, and few others."""
    rows = hashes.withColumn("bloque", _block(F.col("h"), blocks)).join(filter_, "bloque")
    every = F.lit(True)
    for i, b in enumerate(_bits("h")):
        every = every & (F.col(f"p{i}").bitwiseAND(b) != 0)
    return rows.where(every).select("h")


def blocks_for(rows: int) -> int:
    return max(1, -(-rows * BITS // BLOCK_BITS))


def loads(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """(number of the last complete load, its filter's blocks, rows stored until then); zeros for no store."""
    try:
        last = spark.read.parquet(f"{path}/resumen").orderBy(F.desc("carga")).first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return 0, 0, 0
        raise
    return (last.carga, last.bloques, last.registros) if last else (0, 0, 0)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """Documents of all complete loads, with the number of their load in ``carga``."""
    return spark.read.parquet(f"{path}/documentos").where(F.col("carga") <= loads(spark, path)[0])


def _fresh(docs: DataFrame, path: str, filter_: DataFrame, blocks: int, total: int) -> DataFrame:
    """The documents (``total`` of them) whose hash the store doesn't hold, exactly."""
    spark = docs.sparkSession
    hashes = docs.select(F.col(HASH).alias("h")).where("h IS NOT NULL")
    maybe = maybe_known(hashes, filter_, blocks)
    candidates = maybe.count()
    if not candidates:
        return docs
    stored = read_store(spark, path).select(F.col(HASH).alias("h")).where("h IS NOT NULL")

    def kept(hashes: DataFrame) -> DataFrame:
        folder = scratch_path(spark, "hashes")
        hashes.distinct().write.parquet(folder)
        return spark.read.schema("h string").parquet(folder)

    if candidates <= BROADCAST_HASHES:
        known = kept(stored.join(F.broadcast(kept(maybe)), "h", "left_semi"))
        return docs.join(F.broadcast(known), docs[HASH] == known["h"], "left_anti")
    if total - candidates <= BROADCAST_HASHES:
        new = kept(hashes.join(stored, "h", "left_anti"))
        if new.count() <= BROADCAST_HASHES:
            return docs.join(F.broadcast(new), docs[HASH] == new["h"], "left_semi").unionByName(docs.where(F.col(HASH).isNull()))
    return docs.join(stored, docs[HASH] == stored["h"], "left_anti")


def load_new(docs: DataFrame, path: str, least_rows: int = 1_000_000, stored_rows: bool = False) -> dict[str, int]:
    """Store the documents whose hash no earlier load holds; returns the load's number and counts.

    Equal hashes inside one load are all stored (copies are the de-duplication's work); documents without a hash are always
    stored. ``least_rows``: rows that the first filter has room for. ``stored_rows``: the documents are read from written
    files, which give the same rows at each reading; others are written once before they are compared.
    """
    spark = docs.sparkSession
    last, blocks, stored = loads(spark, path)
    number = last + 1
    if not stored_rows:
        batch = scratch_path(spark, "load")
        docs.write.parquet(batch)
        docs = spark.read.schema(docs.schema).parquet(batch)
    total = docs.count()
    fresh = docs
    if last:
        filter_ = spark.read.parquet(f"{path}/filtro/carga={last}")
        fresh = _fresh(docs, path, filter_, blocks, total)
    target = f"{path}/documentos/carga={number}"
    fresh.write.mode("overwrite").parquet(target)
    added = spark.read.schema(docs.schema).parquet(target)
    new = added.count()
    room = blocks * BLOCK_BITS // BITS
    own = added.select(F.col(HASH).alias("h")).where("h IS NOT NULL")
    if not last or stored + new > room:
        blocks = blocks_for(max(least_rows, 2 * (stored + new)))
        before = own if not last else own.unionByName(read_store(spark, path).select(F.col(HASH).alias("h")).where("h IS NOT NULL"))
        filter_ = block_filter(before, blocks)
    else:
        filter_ = merged(filter_.unionByName(block_filter(own, blocks)))
    filter_.write.mode("overwrite").parquet(f"{path}/filtro/carga={number}")
    # The summary's one row commits the load.
    summary = spark.createDataFrame([(number, blocks, stored + new, total, new, total - new)], "carga int, bloques long, registros long, leidos long, nuevos long, repetidos long")
    summary.coalesce(1).write.mode("append").parquet(f"{path}/resumen")
    return {"carga": number, "leidos": total, "nuevos": new, "repetidos": total - new}

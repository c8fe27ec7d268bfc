"""Indexes of the stored tables as layouts: by hash for point lookups, by two columns at once (bit interleaving).

A layout is an index where its files cover narrow ranges: `file_ranges` is the sparse index (one row per
file: smallest and largest value), from which a lookup reads the few files that may hold its keys. Files
are written with at most ``rows_per_file`` rows, so each is one row group, with a Parquet Bloom filter on the hash, which lets
the scan drop a file that a key falls into by range alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MORTON_BITS = 16


def write_hash_indexed(rows: DataFrame, path: str, hash_col: str, rows_per_file: int = 1_000_000) -> None:
    """Rows in hash order: range-partitioned, sorted, one row group per file, Bloom filters on the hash. Rows without a hash come first."""
    (
        rows.repartitionByRange(F.col(hash_col))
        .sortWithinPartitions(hash_col)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option(f"parquet.bloom.filter.enabled#{hash_col}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{hash_col}", str(rows_per_file))
        .parquet(path)
    )


def file_ranges(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """archivo, filas, and lo_0, hi_0, ... of each column: the sparse index of a layout, one row per file."""
    each = [(F.min(c).alias(f"lo_{i}"), F.max(c).alias(f"hi_{i}")) for i, c in enumerate(columns)]
    return spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("archivo")).agg(
        F.count(F.lit(1)).alias("filas"), *[x for pair in each for x in pair]
    )


def lookup(spark: SparkSession, path: str, index: DataFrame, keys: DataFrame, hash_col: str) -> tuple[DataFrame, int]:
    """(rows whose hash is in ``keys``' one column, files read).

    ``index`` is `file_ranges` of the layout, best kept as a table. The files that may hold a key are listed on the
    driver, at most one and its neighbours per key; no other file is opened.
    """
    k = keys.toDF("_k").where("_k IS NOT NULL").distinct()
    span = k.agg(F.min("_k").alias("lo"), F.max("_k").alias("hi")).first()
    near = index.where((F.col("hi_0") >= F.lit(span.lo)) & (F.col("lo_0") <= F.lit(span.hi)))
    hit = near.join(k, F.expr("_k BETWEEN lo_0 AND hi_0"), "left_semi").select("archivo")
    files = [r.archivo for r in hit.collect()]
    if not files:
        return spark.read.parquet(path).where("false"), 0
    rows = spark.read.schema(spark.read.parquet(path).schema).parquet(*files)
    return rows.join(k, F.col(hash_col) == F.col("_k"), "left_semi"), len(files)


def spread_bits(x: Column) -> Column:
    """The lower 16 bits of a number, each followed by a zero bit."""
    x = x.bitwiseAND(0xFFFF)
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(mask)
    return x


def morton(a: Column, b: Column) -> Column:
    """Interleaved bits of two numbers below 2^16, those of ``a`` above."""
    return F.shiftleft(spread_bits(a.cast("long")), 1).bitwiseOR(spread_bits(b.cast("long")))


def scaled(df: DataFrame, column: str, edges: int = 256) -> Column:
    """A column as its share of rows below it, in 16 bits: equal values equal, larger values not smaller; NULL is 0.

    The steps are approximate quantiles (at most ``edges``, from one sketch that combines in the map tasks), so a
    crowded part of the column gets as many steps as its rows deserve.
    """
    at = [i / edges for i in range(1, edges)]
    steps = df.agg(F.array_distinct(F.percentile_approx(column, at, 10 * edges)).alias("s")).first().s
    if not steps:
        return F.lit(0).cast("long")
    below = F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s < F.col(column)))
    return F.coalesce((below * (((1 << MORTON_BITS) - 1) // len(steps))).cast("long"), F.lit(0).cast("long"))


def write_interleaved(rows: DataFrame, path: str, a: str, b: str, tie: str, partitions: int | None = None, rows_per_file: int = 1_000_000) -> None:
    """Rows in the order of the interleaved bits of two columns, so a range of either one skips files.

    ``tie`` is a unique column: it splits rows that agree in both over files.
    """
    rows = rows.withColumn("_z", morton(scaled(rows, a), scaled(rows, b)))
    order = [F.col("_z"), F.col(tie)]
    spread = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    spread.sortWithinPartitions(*order).drop("_z").write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def files_in_range(index: DataFrame, column: int, low, high) -> int:
    """Files of a layout that a range of its index's n-th column doesn't skip."""
    return index.where((F.col(f"hi_{column}") >= F.lit(low)) & (F.col(f"lo_{column}") <= F.lit(high))).count()

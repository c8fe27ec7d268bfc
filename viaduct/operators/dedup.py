"""De-duplication by content hash (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, key: str = "hash_registro", prefer: str = "fichero_origen") -> DataFrame:
    """One row per ``key``: the copy with the smallest ``prefer`` value (NULL last).

    The hash covers the whole record, so copies differ in the lineage column
    only. ``prefer`` takes few values (source files); its rank stands for it,
    which leaves only fixed-width values to aggregate: a hash aggregate that
    combines copies before the shuffle, so a key held by a third of all rows
    sends one row per map task, and nothing is sorted. The result doesn't
    depend on partitioning.

    The ranks (one row per source file) are broadcast by hint: joined by a shuffle, the rows would
    meet in as many tasks as there are source files, and adaptive execution keeps that
    shuffle where most of its partitions are empty.
    """
    rank = df.select(prefer).distinct().withColumn("_rank", F.row_number().over(Window.orderBy(F.col(prefer).asc_nulls_last())))
    files = rank.withColumnRenamed(prefer, "_prefer")
    rest = [c for c in df.columns if c not in (key, prefer)]
    ranked = df.join(F.broadcast(files), F.col(prefer).eqNullSafe(F.col("_prefer"))).drop("_prefer")
    one = ranked.groupBy(key).agg(F.min("_rank").alias("_rank"), *[F.first(c).alias(c) for c in rest])
    back = files.withColumnRenamed("_prefer", prefer)
    return one.join(F.broadcast(back), "_rank").select(*df.columns)

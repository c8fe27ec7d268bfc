"""Surrogate keys: small dimensions and the dense, repeatable fact key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sequential_key(df: DataFrame, order_col: str, key_col: str) -> DataFrame:
    """``key = 1..n`` in ``order_col`` order.

    A global row number runs in one task; use it only on dimensions whose
    size is bounded by a reference list or the calendar, never on facts.
    """
    return df.withColumn(key_col, F.row_number().over(Window.orderBy(F.col(order_col).asc_nulls_first())))


def dense_hash_key(df: DataFrame, hash_col: str, key_col: str, prefix_chars: int = 4) -> DataFrame:
    """Dense ``1..n`` key in ``hash_col`` order without a global sort.

    Equal to ``row_number() OVER (ORDER BY hash_col NULLS FIRST)`` but
    distributed: rows are grouped by the first ``prefix_chars`` hex digits of
    the hash (16^k buckets, uniform because the hash is), numbered inside
    their bucket, and shifted by the running total of the smaller buckets.
    The bucket-count table has at most 16^k rows, which bounds what is
    broadcast. The result does not depend on partitioning.
    """
    bucket = "_key_bucket"
    b = df.withColumn(bucket, F.substring(F.col(hash_col), 1, prefix_chars))
    counts = b.groupBy(bucket).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        bucket,
        F.coalesce(
            F.sum("_n").over(
                Window.orderBy(F.col(bucket).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_offset"),
    )
    ranked = b.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(bucket).orderBy(F.col(hash_col).asc_nulls_first()))
    )
    return (
        ranked.join(F.broadcast(offsets), ranked[bucket].eqNullSafe(offsets[bucket]))
        .withColumn(key_col, (F.col("_offset") + F.col("_rn")).cast("long"))
        .select(*df.columns, key_col)
    )

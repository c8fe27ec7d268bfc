"""First rows of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_rows_per_source(
    df: DataFrame, n: int | None, source_col: str = "fichero_origen", path_col: str = "_ruta", row_index_col: str = "_fila"
) -> DataFrame:
    """The first ``n`` rows of each source (``None`` keeps all).

    A source is one file or a folder of part files, read in path order. Rows
    before a part file come from a count per file (one row per file, broadcast by hint), so the rows
    themselves are only filtered: no sort and no shuffle of rows.
    """
    if n is None:
        return df
    order = Window.partitionBy(source_col).orderBy(path_col).rowsBetween(Window.unboundedPreceding, -1)
    files = df.groupBy(source_col, path_col).agg(F.count(F.lit(1)).alias("_n"))
    before = files.select(F.col(path_col), F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"))
    # A row further down in its own file can't be among the first ones either.
    near = df.where(F.col(row_index_col) < n)
    return near.join(F.broadcast(before), path_col).where(F.col("_before") + F.col(row_index_col) < n).select(*df.columns)


def first_rows_per_group(
    df: DataFrame, group_col: str, order_cols: list[str], n: int | None, salt_buckets: int = 64
) -> DataFrame:
    """The ``n`` first rows of each group in ``order_cols`` order.

    For frames without a file row index. Two ranking rounds keep any single
    task bounded even when one group holds most rows: first inside
    (group, salt) sub-groups, which keeps at most ``n`` rows per sub-group,
    then inside the group over at most ``n × salt_buckets`` candidates. All rows of an
    input partition have one salt, so a map task sends at most ``n`` rows of a group to
    the first round (the planner ranks before the shuffle up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` rows). The order of ``order_cols``
    alone decides, not the salt.
    """
    if n is None:
        return df
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    salted = df.withColumn("_salt", F.spark_partition_id() % salt_buckets)
    stage1 = salted.withColumn("_rn", F.row_number().over(Window.partitionBy(group_col, "_salt").orderBy(*order)))
    cand = stage1.filter(F.col("_rn") <= n).drop("_rn", "_salt")
    stage2 = cand.withColumn("_rn", F.row_number().over(Window.partitionBy(group_col).orderBy(*order)))
    return stage2.filter(F.col("_rn") <= n).drop("_rn")

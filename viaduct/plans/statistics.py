"""Statistics that the planner uses (S17): column histograms, cost-based estimates, join order."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

COST_BASED = {
    "spark.sql.cbo.enabled": "true",
    "spark.sql.cbo.joinReorder.enabled": "true",
    "spark.sql.cbo.planStats.enabled": "true",
    "spark.sql.statistics.histogram.enabled": "true",
    "spark.sql.statistics.histogram.numBins": "254",
}


@contextmanager
def cost_based(spark: SparkSession) -> Iterator[None]:
    """The session plans by cost inside; its settings are as before afterwards."""
    before = {k: spark.conf.get(k, None) for k in COST_BASED}
    for k, v in COST_BASED.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def analyze_with_histograms(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Row count, distinct values, bounds and equal-height histograms of the columns (all if none are named)."""
    with cost_based(spark):
        which = "ALL COLUMNS" if columns is None else "COLUMNS " + ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {which}")


def estimated_rows(df: DataFrame) -> int | None:
    """Rows that the planner expects of a frame, from the cost explanation's first line; None if it has no estimate."""
    spark = df.sparkSession
    df.createOrReplaceTempView("_estimated")
    with cost_based(spark):
        text = spark.sql("EXPLAIN COST SELECT * FROM _estimated").first()[0]
    optimised = text.split("== Optimized Logical Plan ==")[1].strip().splitlines()[0]
    rows = re.search(r"rowCount=([0-9.E+]+)", optimised)
    return int(float(rows[1])) if rows else None

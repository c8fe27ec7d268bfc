"""Physical layouts of the gold fact and their comparison.

*optimised* (the sort-key layout): range-partitioned and sorted by
(date key, origin zone), so every file covers a narrow date-key range and a
date-range filter skips files and row groups by their min/max statistics.
The range boundaries come from a sample and include the unique trip key, so
even a (date, zone) pair holding a third of all trips is split over many
files and tasks.
*bucketed* (the distribution-key analogue): bucketed by origin zone; an
aggregation on the zone needs no exchange, but a bucketed scan reads each
bucket in one task, so a hot zone makes a hot task. Offered, not the default.
*control*: the same rows spread evenly with no physical design.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

OPTIMISED = "optimizada"
CONTROL = "control"


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _default_parts(spark: SparkSession) -> int:
    """One bucket / partition per shuffle partition: sized to the data by the job's configuration."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_optimised(spark: SparkSession, fact: DataFrame, partitions: int | None = None, path: str | None = None,
                    rows_per_file: int = 5_000_000) -> str:
    """Sort-key layout: range-partitioned and sorted by (date key, origin zone)."""
    partitions = partitions or _default_parts(spark)
    name = _table_name("fact_servicio")
    path = path or scratch_path(spark, name)
    (
        fact.repartitionByRange(partitions, "sk_tiempo", "sk_zona_origen", "sk_servicio")
        .sortWithinPartitions("sk_tiempo", "sk_zona_origen")
        .write.mode("overwrite")
        .format("parquet")
        .option("maxRecordsPerFile", rows_per_file)
        .option("path", path)
        .saveAsTable(name)
    )
    return name


def write_bucketed(spark: SparkSession, fact: DataFrame, buckets: int | None = None, path: str | None = None) -> str:
    """Bucketed by origin zone, sorted by (date key, origin zone) inside each bucket."""
    buckets = buckets or _default_parts(spark)
    name = _table_name("fact_servicio_bucketed")
    path = path or scratch_path(spark, name)
    (
        fact.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, "sk_zona_origen")
        .sortBy("sk_tiempo", "sk_zona_origen")
        .option("path", path)
        .saveAsTable(name)
    )
    return name


def write_control(spark: SparkSession, fact: DataFrame, partitions: int | None = None, path: str | None = None) -> str:
    """Even round-robin spread, plain Parquet (control copy, S16)."""
    partitions = partitions or _default_parts(spark)
    name = _table_name("fact_servicio_control")
    path = path or scratch_path(spark, name)
    fact.repartition(partitions).write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return name


def write_dimension_table(spark: SparkSession, df: DataFrame, prefix: str) -> str:
    name = _table_name(prefix)
    df.coalesce(1).write.mode("overwrite").format("parquet").option("path", scratch_path(spark, name)).saveAsTable(name)
    return name


def analyze(spark: SparkSession, table: str) -> None:
    """Table statistics and statistics of all columns."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def compact(spark: SparkSession, df: DataFrame, path: str, sort_cols: list[str], rows_per_file: int = 5_000_000) -> DataFrame:
    """Rewrite a table range-partitioned and sorted (the VACUUM re-sort, S18)."""
    (
        df.repartitionByRange(*[F.col(c) for c in sort_cols])
        .sortWithinPartitions(*sort_cols)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )
    return spark.read.parquet(path)


def analysed_table(spark: SparkSession, path: str, prefix: str) -> str:
    """A written folder as a catalog table with statistics."""
    name = _table_name(prefix)
    spark.catalog.createTable(name, path=path, source="parquet")
    analyze(spark, name)
    return name


def catalog_rows(spark: SparkSession, table: str) -> int | None:
    """Rows of a table as its statistics have them."""
    stats = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Statistics'").first()
    rows = re.search(r"(\d+) rows", stats["data_type"]) if stats else None
    return int(rows[1]) if rows else None


MONTH = "anio_mes"


def with_month(fact: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    """The fact and its month as a number (202302); rows without a date have none."""
    months = dim_tiempo.select("sk_tiempo", (F.col("anio").cast("int") * 100 + F.col("mes").cast("int")).alias(MONTH))
    return fact.join(months, "sk_tiempo", "left").select(*fact.columns, MONTH)


def _by_month(rows: DataFrame):
    """Months with many rows are split over tasks and files."""
    return rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "sk_tiempo", "sk_zona_origen").write.mode("overwrite")


def write_by_month(rows: DataFrame, path: str) -> None:
    """The fact (with `with_month`) in one folder per month; replaces what is there."""
    _by_month(rows).partitionBy(MONTH).parquet(path)


def reload_months(rows: DataFrame, path: str) -> None:
    """Replace the months that ``rows`` hold, and only these.

    Spark writes all files into a staging folder and moves them in when every task is done, so a reload that fails
    before leaves the layout as it was; folders of other months aren't touched. A month without rows in ``rows`` stays.
    """
    _by_month(rows).option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def layout_equivalence(optimised: DataFrame, control: DataFrame) -> DataFrame:
    """Row counts of both layouts and rows present in only one (S20), as one lazy plan.

    A multiset comparison: each distinct row counts +1 per copy in one layout
    and -1 per copy in the other, combined map-side; equal counts with
    different rows are caught and counted.
    """
    sides = optimised.withColumn("_n", F.lit(1)).unionByName(control.withColumn("_n", F.lit(-1)))
    rows = sides.groupBy(*optimised.columns).agg(
        F.sum("_n").alias("d"), F.count_if(F.col("_n") > 0).alias("o"), F.count_if(F.col("_n") < 0).alias("c")
    )
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    out = rows.agg(
        total("o", "n_optimizada"), total("c", "n_control"),
        total(F.greatest("d", F.lit(0)), "solo_optimizada"), total(F.greatest(-F.col("d"), F.lit(0)), "solo_control"),
    )
    return out.withColumn("equivalente", (F.col("solo_optimizada") == 0) & (F.col("solo_control") == 0))


def layout_results(queries: dict[str, Callable[[DataFrame], DataFrame]], layouts: dict[str, DataFrame]) -> DataFrame:
    """What the comparison must hold apart from its timings (A13): per query the
    result rows on both layouts and whether the results are equal."""
    out = None
    for name, build in queries.items():
        both = layout_equivalence(build(layouts[OPTIMISED]), build(layouts[CONTROL]))
        row = both.select(
            F.lit(name).alias("consulta"), F.col("n_optimizada").alias("filas_optimizada"),
            F.col("n_control").alias("filas_control"), F.col("equivalente").alias("iguales"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def _run(df: DataFrame) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def measure_latency(
    spark: SparkSession,
    queries: dict[str, Callable[[DataFrame], DataFrame]],
    layouts: dict[str, DataFrame],
    runs: int = 5,
) -> DataFrame:
    """Median / min / max seconds per query and layout, and control / optimised.

    Each query runs once unmeasured, then ``runs`` times into the ``noop``
    sink (full execution, nothing cached). Refuses to compare layouts whose
    row counts differ.
    """
    counts = {k: v.count() for k, v in layouts.items()}
    if len(set(counts.values())) != 1:
        raise ValueError(f"layouts differ in row count: {counts}")
    rows = []
    for qname, build in queries.items():
        for layout, fact in layouts.items():
            df = build(fact)
            _run(df)
            for i in range(runs):
                rows.append((qname, layout, i, _run(df)))
    timings = spark.createDataFrame(rows, "consulta string, layout string, ronda int, segundos double")
    med = lambda lay: F.round(F.median(F.when(F.col("layout") == lay, F.col("segundos"))), 3)
    mn = lambda lay: F.round(F.min(F.when(F.col("layout") == lay, F.col("segundos"))), 3)
    mx = lambda lay: F.round(F.max(F.when(F.col("layout") == lay, F.col("segundos"))), 3)
    return (
        timings.groupBy("consulta")
        .agg(
            med(OPTIMISED).alias("mediana_optimizada_s"),
            mn(OPTIMISED).alias("min_optimizada_s"),
            mx(OPTIMISED).alias("max_optimizada_s"),
            med(CONTROL).alias("mediana_control_s"),
            mn(CONTROL).alias("min_control_s"),
            mx(CONTROL).alias("max_control_s"),
        )
        .withColumn("mejora_x", F.round(F.col("mediana_control_s") / F.col("mediana_optimizada_s"), 2))
        .orderBy("consulta")
    )

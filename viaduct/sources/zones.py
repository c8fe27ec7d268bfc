"""Zone reference inputs: the public lookup CSV and centroid tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


def read_zone_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """``LocationID, Borough, Zone, service_zone`` with a declared schema."""
    return spark.read.schema(schemas.ZONE_LOOKUP).option("header", True).csv(path)


def write_dimension(df: DataFrame, path: str) -> None:
    """Small dimensions go to one file."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

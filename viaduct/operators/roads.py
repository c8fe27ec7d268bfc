"""Road-network statistics per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def road_stats(edges: DataFrame, nodes: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """Total edge length (km, 2 decimals), intersection count and density.

    edges: id_zona, longitud_m; nodes: id_zona, id_nodo; areas: id_zona, area.
    Lengths are summed and rounded in decimal arithmetic (HALF_UP), so the
    result does not depend on summation order. Density is NULL for a zero or
    unknown area.
    """
    length = edges.groupBy("id_zona").agg(
        F.round(F.sum(F.col("longitud_m").try_cast("decimal(14,3)")) * F.lit(0.001).cast("decimal(4,3)"), 2)
        .cast("decimal(10,2)")
        .alias("long_via_km")
    )
    count = nodes.groupBy("id_zona").agg(F.count_distinct("id_nodo").cast("int").alias("n_intersecciones"))
    stats = length.join(count, "id_zona", "full")
    if areas is None:
        return stats.withColumn("densidad_interseccion", F.lit(None).cast("double"))
    return stats.join(areas.select("id_zona", "area"), "id_zona", "left").select(
        "id_zona",
        "long_via_km",
        "n_intersecciones",
        F.when(F.col("area") > 0, F.round(F.col("n_intersecciones") / F.col("area"), 2)).alias(
            "densidad_interseccion"
        ),
    )


def graph_stats(edges: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """The same statistics of simplified graphs: edges with id_zona, nodo_a, nodo_b, metros; each node and edge counts once."""
    ends = edges.select("id_zona", F.explode(F.array("nodo_a", "nodo_b")).alias("id_nodo"))
    return road_stats(edges.select("id_zona", F.col("metros").alias("longitud_m")), ends, areas)

"""Zone polygons as rows: ring edges, areas and centroids (J1's input).

A polygon is a set of vertex rows: id_zona, anillo (ring), hoyo (the ring is a hole), orden (0, 1, ... along the
ring), x, y (rows without finite coordinates don't count). Rings close by themselves and may run either way. Everything is an
equi-join or a sum, so a ring with any number of vertices is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coordinates are summed as whole thousandths of a map unit: the sums are exact in any order.
GRAIN = 1000


def ring_edges(vertices: DataFrame) -> DataFrame:
    """One row per ring edge: id_zona, anillo, hoyo, orden, x1, y1, x2, y2 (from each vertex to the next, the last one to the first)."""
    ring = ["id_zona", "anillo"]
    v = vertices.where("id_zona IS NOT NULL AND abs(x) < double('infinity') AND abs(y) < double('infinity')")
    sizes = v.groupBy(*ring).agg(F.max("orden").alias("_last"))
    starts = v.join(sizes, ring).select(
        *ring, "hoyo", "orden", F.col("x").alias("x1"), F.col("y").alias("y1"),
        F.when(F.col("orden") == F.col("_last"), F.lit(0)).otherwise(F.col("orden") + 1).cast("long").alias("_next"),
    )
    ends = v.select(*ring, F.col("orden").cast("long").alias("_next"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    return starts.join(ends, [*ring, "_next"]).select(*ring, "hoyo", "orden", "x1", "y1", "x2", "y2")


def _grains(coordinate: Column, origin: Column) -> Column:
    return (F.round(coordinate * GRAIN).cast("long") - origin).cast("decimal(12,0)")


def centroids(edges: DataFrame) -> DataFrame:
    """id_zona, area, x, y: area and area-weighted centroid of each polygon, holes taken off.

    A ring's own direction doesn't matter. Polygons without area (fewer than three vertices, all on a line, or holes as large as the
    rest) have area 0 and NULL coordinates.
    """
    corner = edges.groupBy("id_zona").agg(
        F.min(F.round(F.col("x1") * GRAIN).cast("long")).alias("_x0"), F.min(F.round(F.col("y1") * GRAIN).cast("long")).alias("_y0")
    )
    e = edges.join(corner, "id_zona").select(
        "id_zona", "anillo", "hoyo", "_x0", "_y0",
        *[_grains(F.col(c), F.col("_x0" if c[0] == "x" else "_y0")).alias(c) for c in ("x1", "y1", "x2", "y2")],
    )
    cross = (F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).cast("decimal(25,0)")
    e = e.select("id_zona", "anillo", "hoyo", "_x0", "_y0", cross.alias("_c"), (F.col("x1") + F.col("x2")).alias("_sx"), (F.col("y1") + F.col("y2")).alias("_sy"))
    rings = e.groupBy("id_zona", "anillo", "hoyo", "_x0", "_y0").agg(
        F.sum("_c").cast("decimal(38,0)").alias("_a"), F.sum(F.col("_c") * F.col("_sx")).cast("decimal(38,0)").alias("_mx"),
        F.sum(F.col("_c") * F.col("_sy")).cast("decimal(38,0)").alias("_my"),
    )
    turned = F.when((F.col("_a") < 0) != F.col("hoyo"), F.lit(-1)).otherwise(F.lit(1))
    zones = rings.groupBy("id_zona", "_x0", "_y0").agg(*[F.sum((F.col(c) * turned).cast("decimal(38,0)")).cast("double").alias(c) for c in ("_a", "_mx", "_my")])
    middle = lambda moment, origin: F.when(F.col("_a") > 0, (F.col(origin) + F.col(moment) / (3 * F.col("_a"))) / GRAIN)
    return zones.select(
        "id_zona", (F.when(F.col("_a") > 0, F.col("_a")).otherwise(F.lit(0.0)) / (2 * GRAIN * GRAIN)).alias("area"),
        middle("_mx", "_x0").alias("x"), middle("_my", "_y0").alias("y"),
    )

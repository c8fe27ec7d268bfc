"""Points to zones: cells that cover the polygons, an equi-join, and a crossing test (A12's polygon filter).

The plane is cut into square cells. A cell knows of each polygon the edges that meet it and whether the other edges that a ray
from its lower right corner to the right meets are odd in number, so a point is tested against its own cell's edges alone
and each point row stays one row: no polygon is compared with all points, nothing is grouped by point. The cells of all polygons are one
table, which the planner broadcasts by its size; beyond that the join shuffles by cell, and AQE splits crowded cells.

From the corner c = (R, B) to a point p the ray moves along x = R to p's height, then to p. An edge that doesn't meet the cell changes
on the way only by its ends: one right of R counts where its height lies between B and y. Over all edges of closed rings the ends
cancel out in pairs, so the ends of the cell's own edges stand for those of all others. Ends that have no partner (a ring with a missing
vertex) are given to the cells left of them as edges of no length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Twice the signed area of (edge, point): 0 on the edge's line, positive to its left.
_SIDE = "((e.x2 - e.x1) * (y - e.y1) - (x - e.x1) * (e.y2 - e.y1))"
# Whether a cell's edge, with its ends right of the cell, changes what a ray from the point meets.
_TURNS = (
    f"CASE WHEN e.y1 > y THEN CASE WHEN e.y2 > y THEN e.x2 > z.derecha ELSE {_SIDE} < 0 END <> (e.x1 > z.derecha) "
    f"WHEN e.y2 > y THEN ({_SIDE} > 0) <> (e.x2 > z.derecha) ELSE false END"
)
_BETWEEN = "((e.{0}1 <= {0} AND {0} <= e.{0}2) OR (e.{0}2 <= {0} AND {0} <= e.{0}1))"
_TOUCHES = f"{_BETWEEN.format('x')} AND {_BETWEEN.format('y')} AND {_SIDE} = 0"
_HOLDS = f"exists(z.lados, e -> {_TOUCHES}) OR (size(filter(z.lados, e -> {_TURNS})) % 2 = 1) <> z.impar"
# Cells are widened by this share of their size against rounding.
_MARGIN = 1e-3
# Cells and pairs of cell and edge, for each edge, that the smallest cells may give.
PAIRS_PER_EDGE = 16


def fitting_cell(edges: DataFrame, largest: float) -> float:
    """Cell size, at most ``largest``, for which the table of cells grows in proportion to the edges: some 16 cells and pairs an edge."""
    side = lambda a, b: F.max(F.greatest(a, b)) - F.min(F.least(a, b))
    zone = edges.groupBy("id_zona").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))).alias("largo"),
        (side("x1", "x2") * side("y1", "y2")).alias("area"), F.max(F.greatest(*[F.abs(c) for c in ("x1", "x2", "y1", "y2")])).alias("lejos"),
    )
    t = zone.agg(*[F.sum(c).alias(c) for c in ("n", "largo", "area")], F.max("lejos").alias("lejos")).first()
    if not t["n"]:
        return largest
    size = max(t["largo"] / (PAIRS_PER_EDGE * t["n"]), (t["area"] / (PAIRS_PER_EDGE * t["n"])) ** 0.5, t["lejos"] * 1e-7)
    return min(largest, size) if size > 0 else largest


def polygon_cells(edges: DataFrame, cell: float) -> DataFrame:
    """_cx, _cy, zonas: per cell the polygons that may reach it, by id, each with the edges that meet the cell.

    derecha is the cell's right side; impar whether the rest of the crossings is odd. Cells that no edge meets are there if they are inside.
    """
    margin = cell * _MARGIN
    strip = lambda c: F.floor(c / F.lit(cell))
    e = edges.select("id_zona", "x1", "y1", "x2", "y2")
    box = e.groupBy("id_zona").agg(*[strip(F.min(F.least(f"{c}1", f"{c}2"))).alias(f"_{c}") for c in "xy"], *[strip(F.max(F.greatest(f"{c}1", f"{c}2"))).alias(f"_{c}_") for c in "xy"])
    rows = lambda low, high: F.sequence(F.greatest(strip(low - margin), F.col("_y")), F.least(strip(high + margin), F.col("_y_")))
    hits = e.join(box, "id_zona").withColumn("_cy", F.explode(rows(F.least("y1", "y2"), F.greatest("y1", "y2"))))
    hits = hits.withColumn("_b", F.col("_cy") * F.lit(cell))
    # The edge's part within the row; an edge that is all but level keeps its whole width.
    level = F.abs(F.col("y2") - F.col("y1")) <= 2 * margin
    at = lambda y: F.col("x1") + F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)))) * (F.col("x2") - F.col("x1"))
    ends = [F.when(level, F.col(c)).otherwise(at(y)) for c, y in (("x1", F.col("_b") - margin), ("x2", F.col("_b") + (cell + margin)))]
    hits = hits.withColumns({"_lo": F.greatest(strip(F.least(*ends) - margin), F.col("_x")), "_hi": F.least(strip(F.greatest(*ends) + margin), F.col("_x_"))})
    hits = hits.withColumn("_cruza", (F.col("y1") > F.col("_b")) != (F.col("y2") > F.col("_b")))

    loose = e.select("id_zona", F.explode(F.array(*[F.struct(F.col(f"x{i}").alias("x1"), F.col(f"y{i}").alias("y1")) for i in (1, 2)])).alias("v"))
    loose = loose.groupBy("id_zona", "v").agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1").select("id_zona", "v.*").join(box, "id_zona")
    loose = loose.withColumns({"x2": F.lit(float("-inf")), "y2": F.col("y1")}).withColumn("_cy", F.explode(rows(F.col("y1"), F.col("y1"))))
    loose = loose.withColumns({"_b": F.col("_cy") * F.lit(cell), "_lo": F.col("_x"), "_hi": F.least(strip(F.col("x1") + margin), F.col("_x_")), "_cruza": F.lit(False)})

    met = hits.unionByName(loose).withColumn("_cx", F.explode(F.sequence("_lo", "_hi"))).withColumn("_r", (F.col("_cx") + 1) * F.lit(cell))
    end = lambda i: ((F.col(f"x{i}") > F.col("_r")) & (F.col(f"y{i}") > F.col("_b"))).cast("int")
    met = met.groupBy("id_zona", "_cy", "_cx", "_x", "_r").agg(
        F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("lados"), F.sum(end(1) + end(2)).alias("_ends"),
        F.count_if(F.col("_cruza") & (F.col("_cx") == F.col("_lo"))).alias("_first"),
    )
    right = Window.partitionBy("id_zona", "_cy").orderBy(F.col("_cx").desc())
    met = met.withColumns({
        "_far": F.coalesce(F.sum("_first").over(right.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_left": F.coalesce(F.lead("_cx").over(right), F.col("_x") - 1),
    })
    # Cells between this one and the next to the left that edges meet.
    between = F.when(((F.col("_far") + F.col("_first")) % 2 == 1) & (F.col("_left") + 1 < F.col("_cx")), F.sequence(F.col("_left") + 1, F.col("_cx") - 1))
    empty = met.select("id_zona", "_cy", F.explode(between).alias("_cx"), F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>").alias("lados"), F.lit(True).alias("impar"))
    met = met.select("id_zona", "_cy", "_cx", "lados", ((F.col("_far") + F.col("_ends")) % 2 == 1).alias("impar")).unionByName(empty)
    zone = F.struct("id_zona", "impar", ((F.col("_cx") + 1) * F.lit(cell)).alias("derecha"), "lados")
    return met.groupBy("_cx", "_cy").agg(F.sort_array(F.collect_list(zone)).alias("zonas"))


def locate(points: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """``points`` (with x and y) and id_zona, the smallest id of the polygons that hold the point, else NULL.

    Points on an edge, also on a hole's edge, are inside; points in a hole and points without finite coordinates aren't.
    """
    somewhere = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    at = [F.when(somewhere, F.floor(F.col(c) / F.lit(cell))).alias(n) for c, n in (("x", "_cx"), ("y", "_cy"))]
    placed = points.select("*", *at).join(polygon_cells(edges, cell), ["_cx", "_cy"], "left")
    return placed.withColumn("id_zona", F.expr(f"get(filter(zonas, z -> {_HOLDS}), 0).id_zona")).drop("_cx", "_cy", "zonas")

"""Test adapter: trip records and zones derived from the driver's tables.

The driver ships TPC-H-like tables, not taxi trips. This adapter maps them to
the trip source schema so that every pipeline operator runs over data whose
size grows with the scale factor (see FIXTURES.md §3):

* one trip per ``lineitem ⋈ orders ⋈ supplier ⋈ customer`` row;
* start = ship date + s0 seconds, end = start + s1 seconds (s1 may be
  negative, which exercises the temporal rules); NULL end, distance and
  origin on fixed residues inject the NULL rules;
* rows of every 50th order appear a second time in source file ``f2``, so
  de-duplication by content hash has work to do;
* zones are nations, boroughs are regions; nation 24 has no centroid
  (NULL coordinates);
* the road network stand-in has one edge per line item and one node per
  distinct (zone, part).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import QueryParams
from .tables import read_table

# Fixed values of the fixture (FIXTURES.md §3).
FILE_MAIN = "f1"
FILE_COPY = "f2"
COPY_EVERY_ORDER = 50
NULL_END_EVERY_ORDER = 97
NULL_DISTANCE_EVERY_ORDER = 83
NULL_ORIGIN_EVERY_PART = 89
ZONE_WITHOUT_CENTROID = 24
SERVICE_ZONE = "Yellow Zone"
# Suppliers (two numbers each) that every executor may hold.
BROADCAST_SUPPLIERS = 2_000_000

# HAVING thresholds of Q2 and Q4 over the fixture, the same at every scale.
FIXTURE_Q2_MIN = 5
FIXTURE_Q4_MIN = 100
FIXTURE_Q5 = (date(1998, 2, 1), date(1998, 2, 14))


def query_params() -> QueryParams:
    return QueryParams(
        q2_min_servicios=FIXTURE_Q2_MIN, q4_min_servicios=FIXTURE_Q4_MIN, q5_desde=FIXTURE_Q5[0], q5_hasta=FIXTURE_Q5[1]
    )


def _seconds_after(ts: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(ts) + seconds)


def fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip records (source schema + ``o_orderkey``) with ``fichero_origen``."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    # Line items are clustered by order key, the partitioning a shuffle join
    # with orders needs at scale anyway; it also spreads the small test files
    # (a few row groups each) over every core. They are shuffled this once: customers are joined
    # to the narrow orders first, suppliers (one for hundreds of line items) are broadcast up to a size.
    li = li.repartition("l_orderkey")
    if supplier.count() <= BROADCAST_SUPPLIERS:
        supplier = F.broadcast(supplier)
    orders = orders.join(customer, orders.o_custkey == customer.c_custkey).select("o_orderkey", "c_nationkey")
    base = li.join(orders, li.l_orderkey == orders.o_orderkey).join(supplier, li.l_suppkey == supplier.s_suppkey)
    ship = F.col("l_shipdate").cast("timestamp")
    s0 = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 7919 + F.col("l_partkey") * 11) % 86400
    s1 = (F.col("l_partkey") * 131 + F.col("l_suppkey") * 17 + F.col("l_orderkey") * 7) % 15000 - 150
    files = F.when(
        F.col("l_orderkey") % COPY_EVERY_ORDER == 0, F.array(F.lit(FILE_MAIN), F.lit(FILE_COPY))
    ).otherwise(F.array(F.lit(FILE_MAIN)))
    return base.select(
        F.col("o_orderkey"),
        F.col("l_linenumber").cast("int").alias("VendorID"),
        _seconds_after(ship, s0).alias("tpep_pickup_datetime"),
        F.when(F.col("l_orderkey") % NULL_END_EVERY_ORDER != 0, _seconds_after(ship, s0 + s1)).alias(
            "tpep_dropoff_datetime"
        ),
        F.col("l_quantity").cast("int").alias("passenger_count"),
        F.when(F.col("l_orderkey") % NULL_DISTANCE_EVERY_ORDER != 0, F.col("l_extendedprice") / 1000).alias(
            "trip_distance"
        ),
        F.when(F.col("l_partkey") % NULL_ORIGIN_EVERY_PART != 0, F.col("s_nationkey")).cast("int").alias(
            "PULocationID"
        ),
        F.col("c_nationkey").cast("int").alias("DOLocationID"),
        F.col("l_extendedprice").alias("total_amount"),
        F.explode(files).alias("fichero_origen"),
    )


def fixture_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in the shape of the public zone CSV."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit(SERVICE_ZONE).alias("service_zone"),
    )


def fixture_zone_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone centroids (LocationID, lat, lon); one zone has no geometry (NULL)."""
    nation = read_table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    has_geometry = k != ZONE_WITHOUT_CENTROID
    return nation.select(
        k.cast("int").alias("LocationID"),
        F.when(has_geometry, F.lit(40.5) + k * F.lit(0.017)).cast("double").alias("lat"),
        F.when(has_geometry, F.lit(-74.2) + ((k * 7) % 25) * F.lit(0.02)).cast("double").alias("lon"),
    )


def fixture_road_network(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Road network stand-in: (edges, nodes, zone areas).

    edges: id_zona, longitud_m; nodes: id_zona, id_nodo; areas: id_zona, area.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = li.join(supplier, li.l_suppkey == supplier.s_suppkey)
    edges = joined.select(F.col("s_nationkey").cast("int").alias("id_zona"), F.col("l_quantity").alias("longitud_m"))
    nodes = joined.select(F.col("s_nationkey").cast("int").alias("id_zona"), F.col("l_partkey").alias("id_nodo"))
    nation = read_table(spark, sf_dir, "nation")
    areas = nation.select(
        F.col("n_nationkey").cast("int").alias("id_zona"), (F.col("n_nationkey") * F.lit(1.5)).alias("area")
    )
    return edges, nodes, areas


# Plane of the zone polygons, in whole map units (US survey feet): zones stand in rows of five.
ZONE_STEP, ZONE_HALF, HOLE_HALF = 40_000, 18_000, 3_000
ZONE_ORIGIN = (1_000_000, 200_000)
ZONE_WITHOUT_AREA = 23
HOLE_EVERY_ZONE = 3
WAY_SPAN = 32


def _zone_middle(zone: Column) -> tuple[Column, Column]:
    return F.lit(ZONE_ORIGIN[0]) + (zone % 5) * ZONE_STEP, F.lit(ZONE_ORIGIN[1]) + F.floor(zone / 5) * ZONE_STEP


def fixture_zone_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone polygons: id_zona, anillo, hoyo, orden, x, y (map units).

    The outer ring of a nation has one vertex per customer, in key order along a square and drawn in towards the
    middle by a share that depends on the key; every third nation has a square hole; nation 23 lies on a line, nation 24 has none.
    """
    c = read_table(spark, sf_dir, "customer").where(F.col("c_nationkey") != ZONE_WITHOUT_CENTROID).select("c_custkey", "c_nationkey")
    nation = Window.partitionBy("c_nationkey")
    i = F.row_number().over(nation.orderBy("c_custkey")).cast("long") - 1
    c = c.select("c_custkey", F.col("c_nationkey").cast("long").alias("z"), i.alias("orden"), F.count(F.lit(1)).over(nation).alias("n"))
    side = 2 * ZONE_HALF
    c = c.withColumn("p", F.expr(f"(orden * {4 * side}) div n")).withColumns({"lado": F.expr(f"p div {side}"), "resto": F.expr(f"p % {side}")})
    dx = F.when(F.col("lado") == 0, F.col("resto") - ZONE_HALF).when(F.col("lado") == 1, F.lit(ZONE_HALF)).when(
        F.col("lado") == 2, F.lit(ZONE_HALF) - F.col("resto")
    ).otherwise(F.lit(-ZONE_HALF))
    dy = F.when(F.col("lado") == 0, F.lit(-ZONE_HALF)).when(F.col("lado") == 1, F.col("resto") - ZONE_HALF).when(
        F.col("lado") == 2, F.lit(ZONE_HALF)
    ).otherwise(F.lit(ZONE_HALF) - F.col("resto"))
    share = F.lit(1000) - (F.col("c_custkey") * 37) % 300
    x, y = _zone_middle(F.col("z"))
    flat = F.when(F.col("z") == ZONE_WITHOUT_AREA, F.lit(0)).otherwise(dy)
    outer = c.select(
        F.col("z").cast("int").alias("id_zona"), F.lit(0).alias("anillo"), F.lit(False).alias("hoyo"), "orden",
        ((x * 1000 + dx * share) / 1000.0).cast("double").alias("x"), ((y * 1000 + flat * share) / 1000.0).cast("double").alias("y"),
    )
    corners = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in ((-1, -1), (-1, 1), (1, 1), (1, -1))])
    holed = read_table(spark, sf_dir, "nation").where(f"n_nationkey % {HOLE_EVERY_ZONE} = 0 AND n_nationkey < {ZONE_WITHOUT_AREA}")
    holed = holed.select(F.col("n_nationkey").cast("long").alias("z"), F.posexplode(corners).alias("orden", "v"))
    hole = holed.select(
        F.col("z").cast("int").alias("id_zona"), F.lit(1).alias("anillo"), F.lit(True).alias("hoyo"), F.col("orden").cast("long").alias("orden"),
        (x + F.col("v.dx") * HOLE_HALF).cast("double").alias("x"), (y + F.col("v.dy") * HOLE_HALF).cast("double").alias("y"),
    )
    return outer.unionByName(hole)


def fixture_road_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Road graph: (edges id_arista, nodo_a, nodo_b, metros; nodes id_nodo, x, y).

    Line items of 32 neighbouring order keys are the points of one way, in key order; a point whose part number is
    divisible by four is an intersection that it shares with other ways of the same nation's square.
    """
    # A line number may repeat within an order: such lines are one point.
    li = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("long").alias("o"), F.col("l_linenumber").cast("long").alias("l"))
    li = li.agg(F.min("l_partkey").cast("long").alias("p"), F.sum("l_quantity").alias("l_quantity"))
    li = li.withColumns({"via": F.expr(f"o div {WAY_SPAN}"), "propio": F.lit(1_000_000_000) + F.col("o") * 8 + F.col("l")})
    li = li.withColumn("z", F.col("via") % 25)
    shared = F.col("p") % 4 == 0
    li = li.withColumn("id_nodo", F.when(shared, F.col("z") * 100_000 + F.col("p") % 5000).otherwise(F.col("propio")))
    along = Window.partitionBy("via").orderBy("o", "l")
    edges = li.select(
        (F.col("o") * 8 + F.col("l")).alias("id_arista"), F.col("id_nodo").alias("nodo_a"), F.lead("id_nodo").over(along).alias("nodo_b"),
        F.col("l_quantity").alias("metros"),
    ).where("nodo_b IS NOT NULL")
    width = 2 * ZONE_HALF
    a = F.when(shared, (F.col("p") % 5000) * 7919 + F.col("z") * 104_729).otherwise(F.col("o") * 7919 + F.col("l") * 104_729)
    b = F.when(shared, (F.col("p") % 5000) * 15_485_863 + F.col("z") * 32_452_843).otherwise(F.col("o") * 15_485_863 + F.col("l") * 32_452_843)
    x, y = _zone_middle(F.col("z"))
    nodes = li.select(
        "id_nodo", (x - ZONE_HALF + a % width).cast("double").alias("x"), (y - ZONE_HALF + b % width).cast("double").alias("y")
    ).distinct()
    return edges, nodes

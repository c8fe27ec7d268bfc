"""Simplified road graph: chains of nodes that only bend are one edge (A12's ``simplify``).

Edges: id_arista (unique), nodo_a, nodo_b, metros, and any zone columns. A node is a bend if it has exactly two edges,
to two different nodes besides itself; all other nodes of edges stay. Each edge counts as two darts, one
a direction. A dart that ends at a bend points at the dart that leaves it by the other edge; pointers then double
round by round (each dart takes over the pointer, length and end of the dart it points at), so the rounds
grow with the logarithm of the longest chain. Edges between two nodes that stay take no part, a dart whose chain is at its end isn't
written again, and the first dart of a chain leaves the rounds there, as none points at it. Every join is on dart or edge numbers, of which
one side has each once; a round's new rows are written, so the lineage stays short. Rings that consist of bends alone have no end: they stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _written(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "road-graph")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def darts(edges: DataFrame) -> DataFrame:
    """Both directions of each edge: dardo, arista, desde, hasta, metros. The other direction's number differs in the last bit."""
    def one(last: int, tail: str, head: str) -> DataFrame:
        return edges.select(
            (F.col("id_arista") * 2 + last).alias("dardo"), F.col("id_arista").alias("arista"), F.col(tail).alias("desde"),
            F.col(head).alias("hasta"), "metros",
        )

    return one(0, "nodo_a", "nodo_b").unionByName(one(1, "nodo_b", "nodo_a"))


def bends(every: DataFrame) -> DataFrame:
    """nodo, uno, otro: nodes with two edges to two other nodes, and the two darts that leave each."""
    nodes = every.groupBy(F.col("desde").alias("nodo")).agg(
        F.count(F.lit(1)).alias("n"), F.min("hasta").alias("a"), F.max("hasta").alias("b"), F.min("dardo").alias("uno"), F.max("dardo").alias("otro")
    )
    return nodes.where("n = 2 AND a <> b AND a <> nodo AND b <> nodo").select("nodo", "uno", "otro")


def _with_next(edges: DataFrame) -> DataFrame:
    """``edges`` and, for each direction, the dart that follows at a bend (sigue_0 from a to b, sigue_1 back), else NULL."""
    bend = _written(bends(darts(edges)))
    pairs = F.array(*[F.struct(F.expr(f"{a} ^ 1").alias("dardo"), F.col(b).alias("sigue")) for a, b in (("uno", "otro"), ("otro", "uno"))])
    follows = bend.select(F.explode(pairs).alias("p")).select("p.*")
    for last in (0, 1):
        own = follows.where(F.col("dardo").bitwiseAND(1) == last).select(F.expr("shiftright(dardo, 1)").alias("id_arista"), F.col("sigue").alias(f"sigue_{last}"))
        edges = edges.join(own, "id_arista", "left")
    return _written(edges)


def simplify(edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(edges, nodes, rounds): id_arista, nodo_a, nodo_b, metros, tramos (edges merged); nodo; rounds of doubling.

    A merged edge has the smallest number of its two outer edges' darts' edges, a nodo_a not above nodo_b, and
    the exact decimal sum of the lengths. Edges with a NULL node are left out.
    """
    edges = edges.where("id_arista IS NOT NULL AND nodo_a IS NOT NULL AND nodo_b IS NOT NULL")
    edges = _with_next(_written(edges.select("id_arista", "nodo_a", "nodo_b", F.col("metros").cast("decimal(28,3)").alias("metros"))))
    alone = "sigue_0 IS NULL AND sigue_1 IS NULL"
    one = F.lit(1).cast("long").alias("tramos")

    def dart(last: int, tail: str, head: str) -> Column:
        """Of the nodes, desde is kept for the first dart of a chain alone: its other direction has none to follow."""
        return F.struct(
            (F.col("id_arista") * 2 + last).alias("dardo"), F.col(f"sigue_{last}").alias("sigue"), (F.col("id_arista") * 2 + last).alias("ultimo"), "metros", one,
            F.when(F.col(f"sigue_{1 - last}").isNull(), F.col(tail)).alias("desde"), F.col(head).alias("hasta"),
        )

    state = edges.where(f"NOT ({alone})").select(F.explode(F.array(dart(0, "nodo_a", "nodo_b"), dart(1, "nodo_b", "nodo_a"))).alias("d")).select("d.*")
    ended, whole = state.where("sigue IS NULL"), None
    still, rounds = state.where("sigue IS NOT NULL").count(), 0
    while still:
        going = state.where("sigue IS NOT NULL")
        ahead = going.where("desde IS NULL").unionByName(ended).select(
            F.col("dardo").alias("sigue"), F.col("sigue").alias("sigue2"), F.col("ultimo").alias("ultimo2"), F.col("metros").alias("metros2"), F.col("tramos").alias("tramos2"),
            F.col("hasta").alias("hasta2"),
        )
        state = _written(going.join(ahead, "sigue").select(
            "dardo", F.col("sigue2").alias("sigue"), F.col("ultimo2").alias("ultimo"), (F.col("metros") + F.col("metros2")).cast("decimal(28,3)").alias("metros"),
            (F.col("tramos") + F.col("tramos2")).alias("tramos"), "desde", F.col("hasta2").alias("hasta"),
        ))
        rounds, open_before = rounds + 1, still
        still = state.where("sigue IS NOT NULL").count()
        # A round that ends no pointer leaves only rings.
        if still == open_before:
            break
        at_end = state.where("sigue IS NULL")
        first = at_end.where("desde IS NOT NULL")
        ended, whole = ended.unionByName(at_end.where("desde IS NULL")), first if whole is None else whole.unionByName(first)

    def ordered(df: DataFrame, number: str, a: str, b: str, *rest) -> DataFrame:
        return df.select(F.expr(number).alias("id_arista"), F.least(a, b).alias("nodo_a"), F.greatest(a, b).alias("nodo_b"), "metros", *rest)

    out = ordered(edges.where(alone), "id_arista", "nodo_a", "nodo_b", one)
    if whole is not None:
        out = out.unionByName(ordered(whole.where(F.expr("dardo <= ultimo ^ 1")), "shiftright(least(dardo, ultimo), 1)", "desde", "hasta", "tramos"))
    if still:
        on_ring = state.where("sigue IS NOT NULL AND dardo % 2 = 0").select(F.expr("shiftright(dardo, 1)").alias("id_arista"))
        out = out.unionByName(ordered(edges.join(on_ring, "id_arista", "left_semi"), "id_arista", "nodo_a", "nodo_b", one))
    out = _written(out)
    nodes = out.select(F.explode(F.array("nodo_a", "nodo_b")).alias("nodo")).distinct()
    return out, nodes, rounds


def within_zones(edges: DataFrame, located: DataFrame) -> DataFrame:
    """Edges whose two nodes lie in the same zone, with id_zona; ``located``: id_nodo, id_zona."""
    zone = located.where("id_zona IS NOT NULL")
    a = zone.select(F.col("id_nodo").alias("nodo_a"), "id_zona")
    b = zone.select(F.col("id_nodo").alias("nodo_b"), F.col("id_zona").alias("_otra"))
    return edges.join(a, "nodo_a").join(b, "nodo_b").where("id_zona = _otra").drop("_otra")

"""Exact discrete quantiles of groups of any size, by rounds of histograms (K1, K2).

No group is ever sorted or held in one task. For each group and quantile a bracket of values is kept
that holds the wanted rank. A round counts the rows of each open bracket in ``bins``
ranges of equal width (a hash aggregate that combines in the map tasks), keeps the range of the rank,
and takes that range's smallest and largest value as the next bracket. A bracket ends when both are
equal, or when it holds at most ``finish`` rows, which are then ordered as one short array. Such a round
divides a bracket's width by ``bins``, and its rows likewise unless they crowd together. After a round that
left a bracket more than a quarter of its rows, the next round takes its ranges from an approximate quantile sketch of what is left,
each edge value a range of its own, which cuts the rows themselves to about an ``EDGES``-th whatever
their distribution. So the rounds grow with the logarithm of the largest group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

BINS = 256
FINISH = 4096
EDGES = 16
ACCURACY = 1000


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _same_group(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equal keys; NULL is a group of its own."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return out


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, tuple[int, int]], count: str = "n",
    bins: int = BINS, finish: int = FINISH,
) -> DataFrame:
    """One row per group: its keys, a column per quantile, and the number of values in ``count``.

    A quantile ``(a, b)`` is the smallest value of which at least ``a / b`` of the group's values aren't larger:
    the one of rank ``ceil(n a / b)``, and of rank 1 for 0. NULL values don't count; a group without values isn't
    in the result; NaN is larger than every number. ``df`` is read once per round: give a written table.
    """
    named, keys = list(keys), [f"_k{i}" for i in range(len(keys))]
    k = [F.col(c) for c in keys]
    rows = df.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(named, keys, strict=True)], F.col(f"`{value}`").cast("double").alias("_v")).where("_v IS NOT NULL")
    inf = F.lit(float("inf"))
    finite = F.when(~F.isnan("_v") & (F.abs("_v") != inf), F.col("_v"))
    total = rows.groupBy(*k).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_v") == -inf).alias("_below"), F.count(finite).alias("_rows"),
        F.count_if((F.col("_v") == inf) & ~F.isnan("_v")).alias("_above"), F.min(finite).alias("_lo"), F.max(finite).alias("_hi"),
    )
    wanted = F.array(*[F.struct(F.lit(c).alias("_q"), F.lit(a).cast("long").alias("_a"), F.lit(b).cast("long").alias("_b")) for c, (a, b) in quantiles.items()])
    state = total.select(*k, "_n", "_below", "_rows", "_above", "_lo", "_hi", F.inline(wanted))
    state = state.withColumn("_rank", F.greatest(F.lit(1).cast("long"), F.expr("(_n * _a + _b - 1) div _b")))
    beyond = F.when(F.expr("_rank <= _below"), -inf).when(F.expr("_rank > _below + _rows + _above"), F.lit(float("nan"))).when(F.expr("_rank > _below + _rows"), inf)
    state = state.select(
        *k, "_n", "_q", F.when(beyond.isNull(), F.col("_lo")).otherwise(beyond).alias("_lo"), F.when(beyond.isNull(), F.col("_hi")).otherwise(beyond).alias("_hi"),
        (F.col("_rank") - F.col("_below")).alias("_rank"), F.col("_rows"),
    )
    state = _written(state, "quantile-brackets")
    done = F.col("_lo").eqNullSafe(F.col("_hi"))

    def inside(brackets: DataFrame) -> DataFrame:
        """Rows of each bracket."""
        return rows.alias("r").join(brackets.alias("s"), _same_group("r", "s", keys) & F.expr("r._v BETWEEN s._lo AND s._hi"))

    own = [F.col(f"s.`{c}`") for c in keys]
    # The width of a bracket may pass the largest double, that of its halves doesn't.
    share = F.expr("IF(_hi - _lo < double('infinity'), (_v - _lo) / (_hi - _lo), (_v / 2 - _lo / 2) / (_hi / 2 - _lo / 2))")
    even = F.least(F.floor(share * bins), F.lit(bins - 1).cast("long"))
    # Below the first edge 0, on it 1, between it and the second 2, and so on.
    by_edge = F.expr("CAST(2 * size(filter(_edges, e -> e < _v)) + IF(exists(_edges, e -> e = _v), 1, 0) AS long)")
    crowded, most = False, None
    while True:
        wide = state.where(~done & (F.col("_rows") > finish))
        before, most = most, wide.agg(F.max("_rows")).first()[0]
        if not most:
            break
        crowded = not crowded and before is not None and 4 * most > before
        if crowded:
            at = [i / EDGES for i in range(1, EDGES)]
            edges = inside(wide).groupBy(*own, "_q").agg(F.array_distinct(F.percentile_approx("_v", at, ACCURACY)).alias("_edges"))
            wide = _written(wide.alias("w").join(edges.alias("e"), _same_group("w", "e", keys) & F.expr("w._q = e._q")).select("w.*", "_edges"), "quantile-edges")
        counts = inside(wide).select(*own, "_q", "_rank", F.col("s._n").alias("_n"), (by_edge if crowded else even).alias("_bin"), "_v")
        counts = counts.groupBy(*k, "_q", "_rank", "_n", "_bin").agg(F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = F.sum("_rows").over(Window.partitionBy(*k, "_q").orderBy("_bin"))
        kept = counts.withColumn("_upto", upto).where("_rank <= _upto AND _rank > _upto - _rows")
        kept = kept.select(*k, "_n", "_q", "_lo", "_hi", (F.col("_rank") - (F.col("_upto") - F.col("_rows"))).alias("_rank"), "_rows")
        state = _written(state.where(done | (F.col("_rows") <= finish)).unionByName(kept), "quantile-brackets")

    listed = inside(state.where(~done)).select(*own, "_q", "_rank", F.col("s._n").alias("_n"), "_v")
    listed = listed.groupBy(*k, "_q", "_rank", "_n").agg(F.sort_array(F.collect_list("_v")).alias("_all"))
    found = listed.select(*k, "_n", "_q", F.expr("element_at(_all, CAST(_rank AS int))").alias("_v"))
    found = found.unionByName(state.where(done).select(*k, "_n", "_q", F.col("_lo").alias("_v")))
    wide = found.groupBy(*k, F.col("_n")).agg(*[F.max(F.when(F.col("_q") == c, F.col("_v"))).alias(f"_{i}") for i, c in enumerate(quantiles)])
    return wide.select(
        *[F.col(i).alias(c) for c, i in zip(named, keys, strict=True)], F.col("_n").alias(count), *[F.col(f"_{i}").alias(c) for i, c in enumerate(quantiles)]
    )

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from viaduct.operators.quantiles import exact_quantiles

Q = {"low": (0, 1), "p01": (1, 100), "p50": (1, 2), "p90": (9, 10), "top": (1, 1)}


def by_sorting(rows):
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    out = {}
    for k, values in groups.items():
        values.sort(key=lambda v: (math.isnan(v), v))
        out[k] = (len(values), *(values[max(1, -(-len(values) * a // b)) - 1] for a, b in Q.values()))
    return out


def same(got, want):
    assert {r[0] for r in got} == set(want)
    for r in got:
        assert all(a == b or (math.isnan(a) and math.isnan(b)) for a, b in zip(r[1:], want[r[0]], strict=True)), (r, want[r[0]])


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    return [tuple(r) for r in exact_quantiles(df, ["k"], "v", Q, **how).collect()]


@pytest.mark.parametrize("bins,finish", [(256, 4096), (4, 3)])
def test_groups_of_all_kinds(spark, bins, finish):
    random = np.random.default_rng(5)
    inf, nan = math.inf, math.nan
    rows = [("normal", float(x)) for x in random.normal(size=700)] + [("ties", float(x)) for x in random.integers(0, 4, 500)]
    rows += [("powers", 2.0 ** k) for k in range(-40, 60)] + [("wide", x) for x in (-1.7e308, 1.7e308, 0.0, 1.0, 5e-324, -5e-324)]
    rows += [("one", 3.5), ("ends", -inf), ("ends", inf), ("ends", nan), ("ends", 1.0), ("ends", None), ("nothing", None), (None, 1.0), (None, 2.0)]
    rows += [("nan", nan), ("inf", inf), ("inf", inf), ("below", -inf), ("below", 0.0)]
    same(run(spark, rows, bins=bins, finish=finish), by_sorting(rows))


def test_hot_group_is_never_in_one_task(spark):
    """A third of the rows and more in one group, resolved by histograms alone; equal to quantile_disc."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("k"),
        (F.pmod(F.hash("id"), F.lit(1_000_003)) / 7).alias("v"),
    )
    got = {r.k: (r.n, r.p50, r.p90) for r in exact_quantiles(df, ["k"], "v", {"p50": (1, 2), "p90": (9, 10)}, finish=64).collect()}
    trips = df.toPandas()  # noqa: F841
    want = duckdb.sql("SELECT k, count(*), quantile_disc(v, 0.5), quantile_disc(v, 0.9) FROM trips GROUP BY k").fetchall()
    assert got == {k: (n, a, b) for k, n, a, b in want}


def test_several_and_clashing_keys(spark):
    rows = [(1, "n", 1.0), (1, "n", 5.0), (1, None, 2.0), (None, None, 4.0), (None, None, 3.0)]
    df = spark.createDataFrame(rows, "q long, r string, s double")
    got = exact_quantiles(df, ["q", "r"], "s", {"m": (1, 2)})
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [(1, "n", 2, 1.0), (1, None, 1, 2.0), (None, None, 2, 3.0)]))


def test_no_rows(spark):
    assert run(spark, []) == []

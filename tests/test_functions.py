"""Scalar expressions: content hash, haversine, calendar attributes."""

import hashlib
import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from viaduct.functions import hashing, metrics


def _hash(spark, **values):
    kinds = {int: "long", float: "double", str: "string", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()))
    return df.select(hashing.content_hash([(f.name, F.col(f.name), f.dataType) for f in df.schema.fields]).alias("h")).first().h


def test_hash_canonical_form(spark):
    want = hashlib.sha256("a=1:2|b=3:1.5|z=2:hé".encode()).hexdigest()[:32]
    assert _hash(spark, z="hé", a=2, b=1.5, n=None) == want


def test_hash_text_is_unambiguous(spark):
    assert _hash(spark, a="x|b=y", b="z") != _hash(spark, a="x", b="y|b=z")
    assert _hash(spark, a="~") != _hash(spark, a=None) and _hash(spark, a="") != _hash(spark, a=None)
    assert _hash(spark, a=2.0000001) != _hash(spark, a=2.0000002)
    # a field that isn't there and a NULL one are the same: the hash depends on the record's own values
    assert _hash(spark, a=1, b=None) == _hash(spark, a=1)


def test_fractions_of_a_second_are_kept(spark):
    df = spark.sql("SELECT explode(array('2023-01-01 10:00:00.1', '2023-01-01 10:00:00.9', '2023-01-01 10:00:00')) AS s")
    got = [r.t for r in df.select(hashing.iso_text(F.col("s").cast("timestamp")).alias("t")).collect()]
    assert got == ["2023-01-01T10:00:00.100000", "2023-01-01T10:00:00.900000", "2023-01-01T10:00:00"]


def test_doubles_have_distinct_text(spark):
    df = spark.createDataFrame([(float("nan"),), (1e300,), (-0.5,), (None,)], "x double")
    assert [r.t for r in df.select(hashing.value_text(F.col("x"), T.DoubleType()).alias("t")).collect()] == ["NaN", "1.0E300", "-0.5", None]


def test_struct_hash_uses_sorted_field_names(spark):
    df = spark.createDataFrame([((1, 2),)], "p struct<z:int,a:int>")
    st = df.schema["p"].dataType
    got = df.select(hashing.struct_hash("p", st).alias("h")).collect()[0].h
    assert got == hashlib.sha256(b"a=1:2|z=1:1").hexdigest()[:32]


def test_haversine_matches_python_and_clamps(spark):
    df = spark.createDataFrame([(40.5, -74.2, 40.9, -73.8), (0.0, 0.0, 0.0, 180.0)], "a double, b double, c double, d double")
    got = df.select(metrics.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("k")).collect()

    def hv(lat1, lon1, lat2, lon2):
        p1, p2 = math.radians(lat1), math.radians(lat2)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
        return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(a)))

    assert abs(got[0].k - hv(40.5, -74.2, 40.9, -73.8)) < 1e-9
    assert not math.isnan(got[1].k) and abs(got[1].k - math.pi * 6371.0) < 1e-6


def test_guarded_ratio_never_raises(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    got = [r.r for r in df.select(metrics.guarded_ratio(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [None, None, 1.5]


def test_timestamps_are_formatted_once(spark):
    df = spark.sql("SELECT timestamp_micros(id * 250000) AS t FROM range(9)")
    text = df.select(hashing.iso_text(F.col("t")).alias("s"))
    assert [r.s for r in text.collect()][:5] == ["1970-01-01T00:00:00"] + [f"1970-01-01T00:00:00.{n}0000" for n in (25, 50, 75)] + ["1970-01-01T00:00:01"]
    assert text._jdf.queryExecution().optimizedPlan().toString().count("date_format(") == 1


def test_fixture_shuffles_the_line_items_once(spark):
    from conftest import SF001
    from viaduct.sources import fixture

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture.fixture_trips(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(l_suppkey" not in plan
    # customers meet the orders, not the line items
    assert plan.count("hashpartitioning(o_custkey") == 1 and plan.index("hashpartitioning(l_orderkey") < plan.index("hashpartitioning(o_custkey")

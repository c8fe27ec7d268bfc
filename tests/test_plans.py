"""Physical-plan properties the design relies on at scale."""

from pyspark.sql import functions as F

from viaduct.operators.dedup import dedup_by_key
from viaduct.operators.keys import dense_hash_key
from viaduct.plans import layout
from viaduct.plans import queries as Q


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_joins_never_shuffle_the_trips(warehouse):
    plan = _plan(warehouse.silver_frames.silver)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 3  # corridors, origin zone, destination zone


def test_dedup_combines_copies_before_the_shuffle_without_sorting(spark):
    df = spark.range(20000).select(
        (F.col("id") % 7).cast("string").alias("hash_registro"),
        F.col("id").cast("double").alias("v"),
        (F.col("id") % 3).cast("string").alias("fichero_origen"),
    )
    plan = dedup_by_key(df)._jdf.queryExecution().executedPlan().toString()
    assert "functions=[partial_min(_rank" in plan  # partial (map-side) aggregate feeds the exchange
    assert "SortAggregate" not in plan


def test_dedup_never_gathers_the_rows_by_source_file(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "60"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(20000).selectExpr("sha(string(id % 15000)) hash_registro", "double(id % 15000) v", "if(id < 15000, 'f1', 'f2') fichero_origen")
        out = dedup_by_key(df)
        plan = _plan(out)
        assert out.count() == 15000 and out.where("fichero_origen = 'f1'").count() == 15000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_accepted_rows_are_deduplicated_by_hashing(warehouse):
    from viaduct.plans.silver import build_silver

    frames = build_silver(warehouse.documents, warehouse.geometry)
    assert "SortAggregate" not in frames.clean._jdf.queryExecution().executedPlan().toString()
    assert frames.clean.columns == warehouse.silver_frames.clean.columns
    assert frames.clean.exceptAll(warehouse.silver_frames.clean).isEmpty()


def test_silver_aggregates_by_hashing(warehouse):
    frames = warehouse.silver_frames
    for df in (frames.clean, frames.corridors, frames.silver):
        assert "SortAggregate" not in _plan(df)


def test_dense_key_keeps_the_fact_distributed(spark):
    df = spark.range(10000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    plan = dense_hash_key(df, "h", "k")._jdf.queryExecution().executedPlan().toString()
    # the only single-partition step is the running total over the bucket counts
    assert plan.count("SinglePartition") == 1
    assert "hashpartitioning(_key_bucket" in plan


def test_reference_queries_prune_and_push_down(warehouse):
    g, lay = warehouse.dimension_tables, warehouse.layouts[layout.OPTIMISED]
    q4 = _plan(Q.q4_route_efficiency(lay, g["dim_zona"], warehouse.params))
    assert "IsNotNull(factor_rodeo)" in q4
    assert "ReadSchema: struct<sk_zona_origen:int,distancia_km:decimal(10,3),factor_rodeo:decimal(10,4)>" in q4
    q5 = _plan(Q.q5_date_range(lay, g["dim_tiempo"], g["dim_zona"], warehouse.params))
    assert "sk_tiempo" in q5.split("PushedFilters")[0] and q5.count("Subquery") >= 2  # the key span filters the scan's rows
    assert "rangepartitioning" not in q5
    q1 = _plan(Q.q1_monthly_overview(lay, g["dim_tiempo"]))
    assert "BroadcastHashJoin" in q1 and "SortMergeJoin" not in q1

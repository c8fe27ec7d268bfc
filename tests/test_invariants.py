"""Invariants of the pipeline and shuffle independence."""

import re
from pyspark.sql import functions as F

from viaduct import config
from viaduct.operators import sampling
from viaduct.operators.dedup import dedup_by_key
from viaduct.operators.keys import dense_hash_key


def test_rows_are_partitioned_by_outcome(warehouse):
    sf = warehouse.silver_frames
    total = sf.tagged.count()
    rejected = sf.quarantine.count()
    accepted_copies = sf.tagged.filter(F.col("motivo_rechazo").isNull()).count()
    distinct = sf.clean.count()
    assert rejected + accepted_copies == total == 6116
    assert distinct == warehouse.gold.fact_servicio.count() == 4244
    assert distinct == sf.tagged.filter("motivo_rechazo IS NULL").select("hash_registro").distinct().count()


def test_rule_counts_match_fixture(warehouse):
    got = {r[0]: r[1] for r in warehouse.silver_frames.quarantine.groupBy("motivo_rechazo").count().collect()}
    assert got == {
        config.R1_TEMPORAL_NULO: 69, config.R1_TEMPORAL_INCOHERENTE: 69, config.R2_DURACION: 180,
        config.R3_DISTANCIA: 623, config.R4_VELOCIDAD: 786, config.R7_ZONA_NULA: 66,
    }


def test_observed_report_equals_query_report(warehouse):
    observed = warehouse.write_quarantine()
    assert observed["registros_entrada"] == 6116 and observed["aceptados_con_copias"] == 4323
    assert sum(observed[r] for r in config.RULE_ORDER) == 6116 - 4323


def test_surrogate_keys_unique_and_dense(warehouse):
    g = warehouse.gold
    for df, key in [(g.fact_servicio, "sk_servicio"), (g.dim_tiempo, "sk_tiempo"), (g.dim_zona, "sk_zona"),
                    (g.dim_operador, "sk_operador")]:
        r = df.agg(F.count("*").alias("n"), F.countDistinct(key).alias("d"), F.min(key).alias("lo"),
                   F.max(key).alias("hi")).collect()[0]
        assert r.n == r.d == r.hi and r.lo == 1, key


def test_dense_key_equals_global_row_number_and_ignores_partitioning(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), F.col("id"))
    want = {r.h: i + 1 for i, r in enumerate(df.orderBy("h").collect())}
    for parts in (1, 8):
        got = dense_hash_key(df.repartition(parts), "h", "k", prefix_chars=2).collect()
        assert {r.h: r.k for r in got} == want


def test_dedup_ignores_partitioning(spark):
    rows = [(f"h{i % 50}", f"f{(i * 7) % 3}", i % 50) for i in range(600)]
    df = spark.createDataFrame(rows, "hash_registro string, fichero_origen string, v int")
    a = sorted(dedup_by_key(df.repartition(1)).collect())
    b = sorted(dedup_by_key(df.repartition(8)).collect())
    assert a == b and len(a) == 50 and all(r.fichero_origen == "f0" for r in a)


def test_first_rows_per_group_matches_brute_force(spark):
    rows = [("big" if i % 10 else f"g{i % 3}", i * 7919 % 1000, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, k int, id int")
    got = sorted(tuple(r) for r in sampling.first_rows_per_group(df, "g", ["k", "id"], 25, salt_buckets=4).collect())
    want = []
    for g in {r[0] for r in rows}:
        want += sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))[:25]
    assert got == sorted(want)


def test_first_rows_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(0, 40000, 1, 4).selectExpr("if(id % 100 = 0, 'b', 'a') g", "id * 7919 % 40000 k")
    out = sampling.first_rows_per_group(df, "g", ["k"], 20)
    got = sorted((r.g, r.k) for r in out.collect())
    assert len(got) == 40 and [k for g, k in got if g == "a"] == [k for k in range(100) if k % 100 or k == 0][1:21]
    plan = out._jdf.queryExecution().executedPlan().toString()
    # ranked inside each map task, by a salt that is one value there
    assert "SPARK_PARTITION_ID" in plan and re.search(r"WindowGroupLimit \[g#\d+, _salt#\d+\], .*, 20, Partial", plan)


def test_layouts_are_equivalent(warehouse):
    from viaduct.plans import layout

    lay = warehouse.layouts
    r = layout.layout_equivalence(lay[layout.OPTIMISED], lay[layout.CONTROL]).collect()[0]
    assert r.equivalente and r.n_optimizada == 4244


def test_bucketed_layout_aggregates_on_bucket_key_without_exchange(spark, warehouse):
    from viaduct.plans import layout

    t = spark.table(layout.write_bucketed(spark, warehouse.gold.fact_servicio))
    plan = t.groupBy("sk_zona_origen").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert t.count() == 4244


def test_sort_key_layout_files_cover_narrow_date_ranges(spark, warehouse):
    from viaduct.plans import layout

    opt = warehouse.layouts[layout.OPTIMISED]
    per_file = opt.groupBy(F.input_file_name().alias("f")).agg(F.min("sk_tiempo").alias("lo"), F.max("sk_tiempo").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in per_file.collect())
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))  # files do not overlap in date key


def test_latency_report_shape(spark, warehouse):
    from viaduct.plans import layout
    from viaduct.plans.registry import reference_queries

    qs = reference_queries(warehouse, warehouse.dimension_tables)
    rep = layout.measure_latency(spark, {"Q1": qs["Q1"]}, warehouse.layouts, runs=1).collect()
    assert len(rep) == 1 and rep[0].mejora_x is not None


def test_null_detour_count_matches_fixture(warehouse):
    # FIXTURES.md §3.2: same-zone trips and trips touching the zone without centroid
    assert warehouse.silver.filter(F.col("factor_rodeo").isNull()).count() == 753
    assert warehouse.silver.filter(F.col("distancia_km").isNull()).count() == 63


def test_quality_report_both_ways_agree(warehouse):
    from viaduct.plans import reports

    sf = warehouse.silver_frames
    a = sorted(tuple(r) for r in reports.quality_report(sf.tagged, sf.clean).collect())
    b = sorted(tuple(r) for r in reports.quality_report(sf.tagged).collect())
    assert a == b and len(a) == 6


def test_zone_dimension_without_geometry_or_roads(spark, warehouse):
    from viaduct.operators import zones

    d = zones.dim_zona(zones.zone_geometry(warehouse.zone_lookup, None), None)
    r = d.agg(F.count("*").alias("n"), F.count("lat").alias("lat"), F.count("long_via_km").alias("km")).collect()[0]
    assert (r.n, r.lat, r.km) == (25, 0, 0)
    assert [x.sk_zona for x in d.collect()] == list(range(1, 26))


def test_compaction_keeps_rows_and_sorts(spark, warehouse, tmp_dir):
    import os

    from viaduct.plans import layout

    fact = warehouse.gold_fact
    out = layout.compact(spark, fact, os.path.join(tmp_dir, "c"), ["sk_tiempo", "sk_zona_origen"])
    assert out.exceptAll(fact).count() == 0 and fact.exceptAll(out).count() == 0


def test_reference_queries_agree_on_both_layouts(warehouse):
    from viaduct.plans import layout
    from viaduct.plans.registry import reference_queries

    qs = reference_queries(warehouse, warehouse.dimension_tables)
    for name, build in qs.items():
        a = [tuple(r) for r in build(warehouse.layouts[layout.OPTIMISED]).collect()]
        b = [tuple(r) for r in build(warehouse.layouts[layout.CONTROL]).collect()]
        assert a == b and a, name  # same rows in the same order


def test_layout_guard_finds_a_changed_row(spark, warehouse):
    from viaduct.plans import layout

    opt = warehouse.layouts[layout.OPTIMISED]
    changed = opt.withColumn("n_pasajeros", F.when(F.col("sk_servicio") == 7, F.lit(99).cast("short")).otherwise(F.col("n_pasajeros")))
    r = layout.layout_equivalence(opt, changed).collect()[0]
    assert (r.n_optimizada, r.n_control, r.solo_optimizada, r.solo_control, r.equivalente) == (4244, 4244, 1, 1, False)
    e = layout.layout_equivalence(opt, warehouse.layouts[layout.CONTROL]).collect()[0]
    assert e.equivalente and e.solo_optimizada == 0


def test_fact_is_the_same_with_its_keys_given_last(warehouse):
    """The narrow fact against the whole keyed trips cast afterwards; its shuffle holds no other columns."""
    from viaduct import schemas
    from viaduct.operators.conform import conform
    from viaduct.plans import gold

    args = (warehouse.silver, warehouse.dim_tiempo_raw, warehouse.dim_operador_raw)
    narrow = gold.conformed_fact(*args)
    whole = conform(gold.fact_with_keys(*args), schemas.GOLD["fact_servicio"]).rows
    assert narrow.schema == whole.schema and narrow.count() == whole.count() > 0
    assert narrow.exceptAll(whole).isEmpty() and whole.exceptAll(narrow).isEmpty()
    shuffled = next(line for line in narrow._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(_key_bucket" in line)
    assert shuffled and "ts_inicio" not in narrow._jdf.queryExecution().sparkPlan().toString().split("Window")[1]


def test_rejects_write_neither_silver_nor_keyed_fact(spark):
    """The fact's one reader takes numbered source fields through silver's projection: same rows as from the tables, fewer copies."""
    from viaduct.plans import gold
    from viaduct.plans.warehouse import Warehouse

    w = Warehouse(spark, "/root/testdata/sf0.001")
    got = w.fact_rows
    assert not {"silver", "fact_keyed"} & set(w.paths)
    whole = gold.fact_with_keys(w.silver, w.dim_tiempo_raw, w.dim_operador_raw, w.cfg.key_prefix_hex).select(*got.columns)
    assert got.count() == whole.count() > 0 and got.exceptAll(whole).isEmpty()
    assert w.fact_keyed.columns == got.columns and w.fact_rows is w.fact_keyed

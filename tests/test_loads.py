"""Loads after the first one: re-ingestion detection, months loaded again, SQL text."""

import os

import pytest
from pyspark.sql import functions as F

from viaduct.config import QueryParams
from viaduct.plans import layout, sql_text
from viaduct.plans import queries as Q
from viaduct.sources import fixture, reingest

DOC = "payload struct<v: int>, _ingesta struct<hash_registro: string, fichero_origen: string>"


def docs(spark, hashes, source="a"):
    return spark.createDataFrame([((i,), (h, source)) for i, h in enumerate(hashes)], DOC).repartition(3)


def stored(spark, path):
    return sorted(((r.carga, r._ingesta.hash_registro) for r in reingest.read_store(spark, path).collect()), key=str)


def test_second_load_stores_only_new_records(spark, tmp_dir):
    first = [f"h{i}" for i in range(500)]
    assert reingest.load_new(docs(spark, first), tmp_dir) == {"carga": 1, "leidos": 500, "nuevos": 500, "repetidos": 0}
    again = [f"h{i}" for i in range(400, 700)] + ["h650", None]
    assert reingest.load_new(docs(spark, again), tmp_dir) == {"carga": 2, "leidos": 302, "nuevos": 202, "repetidos": 100}
    assert reingest.load_new(docs(spark, first), tmp_dir) == {"carga": 3, "leidos": 500, "nuevos": 0, "repetidos": 500}
    assert reingest.load_new(docs(spark, []), tmp_dir)["leidos"] == 0
    want = [(1, h) for h in first] + [(2, f"h{i}") for i in range(500, 700)] + [(2, "h650"), (2, None)]
    assert stored(spark, tmp_dir) == sorted(want, key=str)


@pytest.mark.parametrize("limit", [0, 150, 1_000_000])
def test_every_way_of_comparing_gives_the_same_store(spark, tmp_dir, monkeypatch, limit):
    """Few known, few new, and many of both: the hashes broadcast or the documents shuffled."""
    monkeypatch.setattr(reingest, "BROADCAST_HASHES", limit)
    load = lambda n, hashes: reingest.load_new(docs(spark, hashes), tmp_dir, stored_rows=n % 2 == 0)["nuevos"]
    first = [f"h{i}" for i in range(500)]
    assert load(1, first) == 500
    assert load(2, [f"h{i}" for i in range(400, 700)] + ["h650", None]) == 202
    assert load(3, first + ["n1", "n1", None]) == 3
    assert load(4, [f"h{i}" for i in range(250)] + [f"m{i}" for i in range(250)]) == 250
    assert load(5, first) == 0
    got = stored(spark, tmp_dir)
    assert len(got) == 500 + 202 + 3 + 250 and got.count((3, "n1")) == 2 and got.count((3, None)) == 1


def test_stored_documents_are_not_copied_for_a_load(spark, monkeypatch):
    from conftest import SF001
    from viaduct.plans import registry

    made = []
    real = reingest.scratch_path
    monkeypatch.setattr(reingest, "scratch_path", lambda s, n: made.append(n) or real(s, n))
    rows = registry.bronze_reingest(spark, SF001).groupBy("carga").count().collect()
    assert {r.carga for r in rows} == {1, 2} and "load" not in made


def test_store_is_read_only_for_possible_repeats(spark, tmp_dir, monkeypatch):
    """The filter alone decides a load of new records; the exact comparison sees no more than it lets through."""
    reingest.load_new(docs(spark, [f"h{i}" for i in range(2000)]), tmp_dir)

    def never(*_):
        raise AssertionError("the store was read")

    monkeypatch.setattr(reingest, "read_store", never)
    assert reingest.load_new(docs(spark, ["new 1", "new 2"]), tmp_dir)["nuevos"] == 2
    with pytest.raises(AssertionError):
        reingest.load_new(docs(spark, ["h5"]), tmp_dir)


def test_filter_misses_nothing_and_lets_little_through(spark):
    hashes = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("h"))
    blocks = reingest.blocks_for(20_000)
    f = reingest.merged(reingest.block_filter(hashes.where("h < '8'"), blocks).unionByName(reingest.block_filter(hashes.where("h >= '8'"), blocks)))
    assert reingest.maybe_known(hashes, f, blocks).count() == 20_000
    others = spark.range(20_000, 60_000).select(F.md5(F.col("id").cast("string")).alias("h"))
    assert reingest.maybe_known(others, f, blocks).count() < 200
    plan = reingest.maybe_known(hashes, f, blocks)._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "Join" in plan


def test_filter_grows_with_the_store(spark, tmp_dir):
    reingest.load_new(docs(spark, [f"a{i}" for i in range(50)]), tmp_dir, least_rows=64)
    blocks = reingest.loads(spark, tmp_dir)[1]
    reingest.load_new(docs(spark, [f"b{i}" for i in range(500)]), tmp_dir, least_rows=64)
    assert reingest.loads(spark, tmp_dir)[1] > blocks
    assert reingest.load_new(docs(spark, ["a7", "b7", "c7"]), tmp_dir)["nuevos"] == 1


def test_broken_load_is_replaced(spark, tmp_dir):
    """Documents of a load that never wrote its summary don't count and are overwritten."""
    reingest.load_new(docs(spark, ["x"]), tmp_dir)
    docs(spark, ["lost", "x"]).write.parquet(f"{tmp_dir}/documentos/carga=2")
    assert stored(spark, tmp_dir) == [(1, "x")]
    assert reingest.load_new(docs(spark, ["x", "y"]), tmp_dir) == {"carga": 2, "leidos": 2, "nuevos": 1, "repetidos": 1}
    assert stored(spark, tmp_dir) == [(1, "x"), (2, "y")]


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_reloaded_month_leaves_the_others_alone(spark, warehouse, tmp_dir):
    path = f"{tmp_dir}/months"
    rows = layout.with_month(warehouse.gold_fact, warehouse.gold_dim_tiempo)
    layout.write_by_month(rows, path)
    before = files(path)
    layout.reload_months(rows.where("anio_mes = 199802").limit(3), path)
    after = files(path)
    same = lambda part: {f: t for f, t in part.items() if "anio_mes=199802" not in f}
    assert same(before) == same(after) and set(before) != set(after)
    assert spark.read.parquet(path).where("anio_mes = 199802").count() == 3
    layout.reload_months(rows.where("false"), path)
    assert files(path) == after


def test_failed_reload_changes_nothing(spark, warehouse, tmp_dir):
    path = f"{tmp_dir}/months"
    rows = layout.with_month(warehouse.gold_fact, warehouse.gold_dim_tiempo).where("anio_mes IN (199801, 199802, 199803)")
    layout.write_by_month(rows, path)
    before = files(path)
    broken = rows.withColumn("hora", F.when(F.col("sk_servicio") > 10, F.raise_error(F.lit("broken")).cast("smallint")).otherwise(F.col("hora")))
    with pytest.raises(Exception, match="broken"):
        layout.reload_months(broken, path)
    assert files(path) == before


def test_rows_without_a_date_have_a_folder_of_their_own(spark, warehouse, tmp_dir):
    rows = warehouse.gold_fact.limit(5).withColumn("sk_tiempo", F.when(F.col("sk_servicio") % 2 == 0, F.col("sk_tiempo")))
    months = layout.with_month(rows, warehouse.gold_dim_tiempo)
    layout.write_by_month(months, f"{tmp_dir}/odd")
    assert spark.read.parquet(f"{tmp_dir}/odd").count() == 5


def test_q5_prunes_months_at_run_time(spark, warehouse, tmp_dir):
    path = f"{tmp_dir}/months"
    layout.write_by_month(layout.with_month(warehouse.gold_fact, warehouse.gold_dim_tiempo), path)
    q5 = Q.q5_by_month(spark.read.parquet(path), warehouse.gold_dim_tiempo, warehouse.gold_dim_zona, warehouse.params)
    assert "dynamicpruning" in q5._jdf.queryExecution().executedPlan().toString()
    want = Q.q5_date_range(warehouse.gold_fact, warehouse.gold_dim_tiempo, warehouse.gold_dim_zona, warehouse.params)
    assert [tuple(r) for r in q5.collect()] == [tuple(r) for r in want.collect()]


def test_sections_of_sql_text():
    text = "ignored\n-- consulta: A\nSELECT 1\n-- a comment\nFROM t\n\n-- consulta: B b\n\nSELECT 2\n"
    assert sql_text.sections(text) == {"A": "SELECT 1\nFROM t", "B b": "SELECT 2"}
    assert sql_text.sections("") == {}
    with pytest.raises(ValueError):
        sql_text.sections("-- consulta: A\n-- consulta: A\n")
    assert list(sql_text.reference_sql()) == ["Q1", "Q2", "Q3", "Q4", "Q5"]


def test_markers_are_values_not_text(spark):
    """A value can't change the statement, and every marker is bound."""
    spark.range(3).createOrReplaceTempView("t_values")
    params = QueryParams(q2_min_servicios=1)
    got = sql_text.run(spark, "SELECT id FROM IDENTIFIER(:fact) WHERE id > :q2_min_servicios", {"fact": "t_values", "dim_zona": "missing"}, params)
    assert [r.id for r in got.collect()] == [2]
    with pytest.raises(Exception, match="(?i)identifier|parse|table"):
        sql_text.run(spark, "SELECT id FROM IDENTIFIER(:fact)", {"fact": "t_values; DROP TABLE t_values"}, params).collect()


def test_sql_text_equals_frames(spark, warehouse):
    tables = {"fact": sql_text.registered(warehouse.gold_fact, "fact")}
    tables |= {n: sql_text.registered(getattr(warehouse, f"gold_{n}"), n) for n in ("dim_tiempo", "dim_zona")}
    args = (warehouse.gold_fact, warehouse.gold_dim_tiempo, warehouse.gold_dim_zona)
    frames = {"Q1": Q.q1_monthly_overview(*args[:2]), "Q2": Q.q2_unreliable_corridors(args[0], args[2], fixture.query_params()), "Q5": Q.q5_date_range(*args, fixture.query_params())}
    for name, df in frames.items():
        got = sql_text.run(spark, sql_text.reference_sql()[name], tables, fixture.query_params())
        assert got.columns == df.columns
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in df.collect()]

"""Indexes of stored tables and statistics for the planner."""

import glob
import random

from pyspark.sql import functions as F

from viaduct.plans import indexes, layout, statistics


def hashed(spark, n):
    return spark.range(n).select(F.md5(F.col("id").cast("string")).alias("h"), F.col("id").alias("v"))


def test_lookup_reads_few_files(spark, tmp_dir):
    path = f"{tmp_dir}/h"
    indexes.write_hash_indexed(hashed(spark, 20_000).unionByName(spark.range(5).select(F.lit(None).cast("string").alias("h"), F.col("id").alias("v"))), path, "h", 400)
    index = indexes.file_ranges(spark, path, "h")
    assert index.count() >= 50 and index.agg(F.max("filas")).first()[0] <= 400
    keys = spark.createDataFrame([(r.h,) for r in hashed(spark, 3).collect()] + [("ffff no such",), (None,)], "k string")
    rows, read = indexes.lookup(spark, path, index, keys, "h")
    assert sorted(r.v for r in rows.collect()) == [0, 1, 2] and 1 <= read <= 8
    none, read = indexes.lookup(spark, path, index, keys.where("false"), "h")
    assert none.count() == 0 and read == 0 and none.columns == rows.columns


def test_files_of_the_hash_order_do_not_overlap_and_carry_bloom_filters(spark, tmp_dir):
    import pyarrow.parquet as pq

    path = f"{tmp_dir}/h"
    indexes.write_hash_indexed(hashed(spark, 5000), path, "h", 500)
    ranges = sorted((r.lo_0, r.hi_0) for r in indexes.file_ranges(spark, path, "h").collect())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    files = glob.glob(f"{path}/*.parquet")
    assert all(pq.ParquetFile(f).num_row_groups == 1 for f in files)
    plain = f"{tmp_dir}/plain"
    spark.read.parquet(path).repartitionByRange("h").sortWithinPartitions("h").write.option("maxRecordsPerFile", 500).parquet(plain)
    size = lambda p: sum(len(open(f, "rb").read()) for f in glob.glob(f"{p}/*.parquet"))
    assert size(path) > size(plain)


def test_bits_interleave(spark):
    pairs = [(random.Random(i).randrange(1 << 16), random.Random(-i - 1).randrange(1 << 16)) for i in range(200)] + [(0, 0), (65535, 65535), (0, 65535), (65535, 0)]
    want = [sum((((a >> k) & 1) << (2 * k + 1)) | (((b >> k) & 1) << (2 * k)) for k in range(16)) for a, b in pairs]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a int, b int")
    assert [r.z for r in df.select("i", indexes.morton(F.col("a"), F.col("b")).alias("z")).orderBy("i").collect()] == want


def test_scale_keeps_order(spark):
    df = spark.createDataFrame([(x,) for x in [None, 5, 5, 1, 9, 9, 9, 1000, -3]], "x int")
    got = sorted((r.x, r.s) for r in df.select("x", indexes.scaled(df, "x").alias("s")).where("x IS NOT NULL").collect())
    assert all(a[1] <= b[1] for a, b in zip(got, got[1:])) and got[0][1] == 0 and got[-1][1] < 1 << 16
    assert df.where("x IS NULL").select(indexes.scaled(df, "x").alias("s")).first().s == 0
    empty = df.where("false")
    assert empty.select(indexes.scaled(empty, "x")).count() == 0


def test_interleaved_layout_skips_by_either_column(spark, tmp_dir):
    """Also where a third of the rows share one value of a column."""
    rows = spark.range(40_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(1000))).alias("a"), F.pmod(F.xxhash64("id"), F.lit(5000)).cast("int").alias("b")
    )
    path = f"{tmp_dir}/z"
    indexes.write_interleaved(rows, path, "a", "b", "id", partitions=64)
    index = indexes.file_ranges(spark, path, "a", "b")
    total = index.count()
    assert total >= 60 and spark.read.parquet(path).columns == ["id", "a", "b"]
    assert indexes.files_in_range(index, 0, 900, 999) <= total / 3 and indexes.files_in_range(index, 1, 100, 300) <= total / 3
    assert index.agg(F.max("filas")).first()[0] < 3 * 40_000 / total
    assert spark.read.parquet(path).exceptAll(rows).isEmpty()


def test_estimates_follow_the_histogram(spark, tmp_dir):
    """A skewed column: without histograms the planner takes its values for even."""
    spark.range(20_000).select(F.col("id"), F.when(F.col("id") < 19_000, F.col("id") % 10).otherwise(F.col("id")).alias("x")).write.parquet(f"{tmp_dir}/s")
    name = layout.analysed_table(spark, f"{tmp_dir}/s", "skewed")
    assert layout.catalog_rows(spark, name) == 20_000
    statistics.analyze_with_histograms(spark, name, ["x"])
    guess = statistics.estimated_rows(spark.table(name).where("x < 100"))
    assert 17_000 <= guess <= 20_000
    assert 500 <= statistics.estimated_rows(spark.table(name).where("x > 15000")) <= 2500


def test_settings_are_put_back(spark):
    before = {k: spark.conf.get(k, None) for k in statistics.COST_BASED}
    try:
        with statistics.cost_based(spark):
            assert spark.conf.get("spark.sql.cbo.enabled") == "true"
            raise KeyError
    except KeyError:
        pass
    assert {k: spark.conf.get(k, None) for k in statistics.COST_BASED} == before

"""Every registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
import oracle_sql

SF001 = "/root/testdata/sf0.001"

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def _rows(records, order):
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def oracle():
    return oracle_sql.ORACLE


NAMES = sorted(oracle_sql.ORACLE)
DUCK_TYPES = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.ShortType: "SMALLINT", T.DoubleType: "DOUBLE",
              T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, oracle, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = df.collect()
    rel = duck.sql(oracle[name])
    assert sorted(cols) == sorted(rel.columns)
    spark_types = {f.name: DUCK_TYPES.get(type(f.dataType), str(f.dataType)) for f in df.schema.fields}
    assert spark_types == dict(zip(rel.columns, [str(t) for t in rel.types]))
    want = rel.fetchall()
    assert len(got) == len(want)
    assert _rows(got, sorted(range(len(cols)), key=lambda i: cols[i])) == _rows(
        want, sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    )


def test_every_query_has_an_oracle():
    from viaduct.plans.registry import QUERIES

    assert set(QUERIES) == set(NAMES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 83
    assert df.columns == ["anio", "mes", "n_servicios", "duracion_media", "velocidad_media", "desviacion_media_eta"]

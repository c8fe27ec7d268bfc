"""The five reference star-schema queries (Q1-Q5).

Averages of the gold decimals are exact decimal means rounded once, HALF_UP,
to six places and returned as doubles. Top-k queries order by the measure and then by
the group keys, so ties give the same rows on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import QueryParams


def _avg(df: DataFrame, c: str) -> Column:
    """Exact decimal mean of ``df[c]``, rounded once HALF_UP to six places, as a double.

    Formed as ``sum / count`` in decimal arithmetic (20+ places kept before
    the single rounding). ``avg`` is not used: for small decimals Spark
    rewrites it to a double average of the unscaled values, which is fast but
    loses exactness once the sum passes 2^53, and for scales above 2 it
    rounds twice.
    """
    return F.round(F.try_divide(F.sum(F.col(c)), F.count(F.col(c))), 6).cast("double")


def _ordered(df: DataFrame, *order: str | Column) -> DataFrame:
    """A result bounded by the calendar or the boroughs, in order: one small exchange and a sort, no sampling job."""
    return df.repartition(1).sortWithinPartitions(*order)


def q1_monthly_overview(fact: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    t = dim_tiempo.select("sk_tiempo", "anio", "mes")
    return _ordered(
        fact.join(t, "sk_tiempo")
        .groupBy("anio", "mes")
        .agg(
            F.count(F.lit(1)).alias("n_servicios"),
            _avg(fact, "duracion_min").alias("duracion_media"),
            _avg(fact, "velocidad_kmh").alias("velocidad_media"),
            _avg(fact, "desviacion_eta_pct").alias("desviacion_media_eta"),
        ),
        "anio", "mes",
    )


def q2_unreliable_corridors(
    fact: DataFrame, dim_zona: DataFrame, params: QueryParams = QueryParams(), top: int = 25
) -> DataFrame:
    zo = dim_zona.select(F.col("sk_zona").alias("sk_zona_origen"), F.col("nombre_zona").alias("origen"))
    zd = dim_zona.select(F.col("sk_zona").alias("sk_zona_destino"), F.col("nombre_zona").alias("destino"))
    return (
        fact.join(zo, "sk_zona_origen")
        .join(zd, "sk_zona_destino")
        .groupBy("origen", "destino", "franja_horaria")
        .agg(
            F.count(F.lit(1)).alias("n_servicios"),
            _avg(fact, "eta_referencia_min").alias("eta_mediana"),
            _avg(fact, "fiabilidad_corredor").alias("fiabilidad"),
        )
        .filter(F.col("n_servicios") > params.q2_min_servicios)
        .orderBy(F.col("fiabilidad").desc_nulls_last(), "origen", "destino", "franja_horaria")
        .limit(top)
    )


def q3_band_degradation(fact: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    t = dim_tiempo.select("sk_tiempo", "nombre_dia")
    return _ordered(
        fact.join(t, "sk_tiempo")
        .groupBy("nombre_dia", "franja_horaria")
        .agg(
            _avg(fact, "duracion_min").alias("duracion_media"),
            _avg(fact, "desviacion_eta_pct").alias("desviacion_media"),
            _avg(fact, "velocidad_kmh").alias("velocidad_media"),
        ),
        "nombre_dia", "franja_horaria",
    )


def q4_route_efficiency(
    fact: DataFrame, dim_zona: DataFrame, params: QueryParams = QueryParams(), top: int = 20
) -> DataFrame:
    zo = dim_zona.select(F.col("sk_zona").alias("sk_zona_origen"), "distrito", "nombre_zona")
    return (
        fact.filter(F.col("factor_rodeo").isNotNull())
        .join(zo, "sk_zona_origen")
        .groupBy("distrito", "nombre_zona")
        .agg(
            F.count(F.lit(1)).alias("n_servicios"),
            _avg(fact, "factor_rodeo").alias("rodeo_medio"),
            _avg(fact, "distancia_km").alias("distancia_media"),
        )
        .filter(F.col("n_servicios") > params.q4_min_servicios)
        .orderBy(F.col("rodeo_medio").desc_nulls_last(), "distrito", "nombre_zona")
        .limit(top)
    )


def q5_date_range(
    fact: DataFrame, dim_tiempo: DataFrame, dim_zona: DataFrame, params: QueryParams = QueryParams()
) -> DataFrame:
    """Trips and mean duration per borough of origin for a date range.

    The date keys of the range span [lo, hi]. Two scalar subqueries over the
    date dimension filter the fact by that span before the join (on the layout
    sorted by date key, files outside it hold no such rows); the join applies the exact dates.
    The query is one lazy plan.
    """
    t = dim_tiempo.filter(F.col("fecha").between(F.lit(params.q5_desde), F.lit(params.q5_hasta))).select("sk_tiempo")
    lo, hi = (t.select(f("sk_tiempo")).scalar() for f in (F.min, F.max))
    zo = dim_zona.select(F.col("sk_zona").alias("sk_zona_origen"), "distrito")
    return _ordered(
        fact.filter(F.col("sk_tiempo").between(lo, hi))
        .join(t, "sk_tiempo")
        .join(zo, "sk_zona_origen")
        .groupBy("distrito")
        .agg(F.count(F.lit(1)).alias("n_servicios"), _avg(fact, "duracion_min").alias("duracion_media")),
        F.col("n_servicios").desc(), "distrito",
    )


def q5_by_month(
    fact: DataFrame, dim_tiempo: DataFrame, dim_zona: DataFrame, params: QueryParams = QueryParams()
) -> DataFrame:
    """Q5 over the layout by month: the join on the month as well lets Spark prune the folders at run time by the dates found."""
    month = (F.col("anio").cast("int") * 100 + F.col("mes").cast("int")).alias("anio_mes")
    t = dim_tiempo.filter(F.col("fecha").between(F.lit(params.q5_desde), F.lit(params.q5_hasta))).select("sk_tiempo", month)
    zo = dim_zona.select(F.col("sk_zona").alias("sk_zona_origen"), "distrito")
    return _ordered(
        fact.join(t, ["anio_mes", "sk_tiempo"])
        .join(zo, "sk_zona_origen")
        .groupBy("distrito")
        .agg(F.count(F.lit(1)).alias("n_servicios"), _avg(fact, "duracion_min").alias("duracion_media")),
        F.col("n_servicios").desc(), "distrito",
    )

"""Bronze documents to the silver trip fact (the quality and KPI stage)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import config
from ..config import Thresholds
from ..operators import corridor, quality, zones
from ..operators.dedup import dedup_by_key
from ..operators.flatten import flatten_documents

Materialize = Callable[[DataFrame], DataFrame]


@dataclass
class SilverFrames:
    flat: DataFrame
    tagged: DataFrame
    quarantine: DataFrame
    once: DataFrame
    clean: DataFrame
    corridors: DataFrame
    silver: DataFrame


def build_silver(
    docs: DataFrame,
    geometry: DataFrame,
    thresholds: Thresholds = Thresholds(),
    materialize: Materialize | None = None,
) -> SilverFrames:
    """Lazy silver stage.

    flatten → measures → first-broken-rule tag → accepted rows de-duplicated
    by content hash → calendar → corridor percentiles joined back → zone
    keys, geodesic distance and detour.

    With ``materialize`` (write a table to the shared checkpoint folder and
    read it back) the de-duplicated rows are computed once: the corridor
    aggregate then reads only its five columns from that table, and the planner knows the
    size of the written corridor table and broadcasts it while it is small, so the
    trips are shuffled once (by hash, to de-duplicate). Without it the plan is one
    lazy query.
    """
    flat = flatten_documents(docs)
    tagged = quality.tag_quality(quality.derive_metrics(flat), thresholds)
    quar = quality.quarantine(tagged)
    # Only the source fields are shuffled and written, all of fixed width apart from the hash: the measures
    # are derived again from them, and accepted rows have no reason.
    once = dedup_by_key(quality.accepted(tagged).select(*flat.columns))
    once = materialize(once) if materialize else once
    clean = clean_trips(once)
    corridors = corridor.corridor_stats(clean)
    corridors = materialize(corridors) if materialize else corridors
    return SilverFrames(flat, tagged, quar, once, clean, corridors, enriched(clean, corridors, geometry))


def clean_trips(once: DataFrame) -> DataFrame:
    """Measures and calendar of the de-duplicated trips; columns beside the source fields are kept."""
    return corridor.add_calendar(quality.derive_metrics(once).withColumn(quality.MOTIVO, F.lit(None).cast("string")))


def enriched(clean: DataFrame, corridors: DataFrame, geometry: DataFrame) -> DataFrame:
    """Corridor KPIs, zone keys, distance and detour of clean trips: the silver columns."""
    return zones.enrich_zones(corridor.attach_corridor_kpis(clean, corridors), geometry)


def quality_observation(tagged: DataFrame, name: str = "calidad") -> tuple[DataFrame, Observation]:
    """Attach input / accepted / per-rule counts to a pass over ``tagged``."""
    obs = Observation(name)
    m = F.col(quality.MOTIVO)
    metrics = [F.count(F.lit(1)).alias("registros_entrada"), F.count_if(m.isNull()).alias("aceptados_con_copias")]
    metrics += [F.count_if(m == F.lit(r)).alias(r) for r in config.RULE_ORDER]
    return tagged.observe(obs, *metrics), obs


def write_silver(silver: DataFrame, path: str, rows_per_file: int = 2_000_000) -> None:
    """Silver fact partitioned by date.

    The rebalance hint clusters rows by date but lets AQE split a date that
    holds a large share of the trips into several tasks (and merge small
    dates), instead of one task and one file per date.
    """
    (
        silver.hint("rebalance", "fecha")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("fecha")
        .parquet(path)
    )


def write_quarantine(quar: DataFrame, path: str) -> None:
    quar.write.mode("overwrite").parquet(path)

"""All stages over one set of inputs, each written once and read back.

``Warehouse`` wires the sources (here: the fixture adapter over the driver's
tables) to the bronze, silver and gold builders. Every stage boundary is a
Parquet table written to the session's shared checkpoint folder and read
back, but where a stage only projects the one before (silver is the clean trips with
broadcast lookups) and one later stage reads it: later stages never recompute earlier ones, a lost executor only
re-runs tasks of the current stage, and downstream reads get column pruning
and filter pushdown on the written table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..config import PipelineConfig, QueryParams
from ..operators import dims, geometry, road_graph, roads, spatial, zones
from ..operators.conform import conform
from ..session import ensure_pipeline_conf, scratch_path
from ..sources import bronze, fixture
from . import gold as gold_plan
from . import layout
from . import silver as silver_plan


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, cfg: PipelineConfig = PipelineConfig(),
                 materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self.cfg = cfg
        self.materialize = materialize
        self.paths: dict[str, str] = {}
        ensure_pipeline_conf(spark)

    # -- helpers ---------------------------------------------------------
    def _write(self, df: DataFrame, name: str, single_file: bool = False) -> DataFrame:
        """Write ``df`` as a table in the checkpoint folder and read it back."""
        if not self.materialize:
            return df
        path = scratch_path(self.spark, name)
        (df.coalesce(1) if single_file else df).write.mode("overwrite").parquet(path)
        self.paths[name] = path
        return self.spark.read.parquet(path)

    def _cut(self, df: DataFrame) -> DataFrame:
        return self._write(df, "stage")

    @property
    def params(self) -> QueryParams:
        return fixture.query_params()

    # -- sources and bronze ------------------------------------------------
    @cached_property
    def trips(self) -> DataFrame:
        return fixture.fixture_trips(self.spark, self.sf_dir)

    @cached_property
    def documents(self) -> DataFrame:
        """Bronze store: documents written as nested Parquet and read back."""
        docs = bronze.to_documents(self.trips, version=self.cfg.version_esquema)
        if not self.materialize:
            return docs
        path = scratch_path(self.spark, "bronze")
        bronze.write_documents(docs, path)
        self.paths["bronze"] = path
        return bronze.read_documents(self.spark, path)

    @cached_property
    def zone_lookup(self) -> DataFrame:
        return fixture.fixture_zone_lookup(self.spark, self.sf_dir)

    @cached_property
    def geometry(self) -> DataFrame:
        centroids = fixture.fixture_zone_centroids(self.spark, self.sf_dir)
        return self._write(zones.zone_geometry(self.zone_lookup, centroids), "zone_geometry", single_file=True)

    @cached_property
    def road_stats(self) -> DataFrame:
        edges, nodes, areas = fixture.fixture_road_network(self.spark, self.sf_dir)
        return roads.road_stats(edges, nodes, areas)

    @cached_property
    def dim_zona(self) -> DataFrame:
        return zones.dim_zona(self.geometry, self.road_stats)

    # -- zone polygons and road graph --------------------------------------
    @cached_property
    def zone_edges(self) -> DataFrame:
        return self._write(geometry.ring_edges(fixture.fixture_zone_vertices(self.spark, self.sf_dir)), "zone_edges")

    @cached_property
    def located_nodes(self) -> DataFrame:
        """Road nodes with the zone whose polygon holds them."""
        nodes = fixture.fixture_road_graph(self.spark, self.sf_dir)[1]
        cell = spatial.fitting_cell(self.zone_edges, fixture.ZONE_STEP / 16)
        return self._write(spatial.locate(nodes, self.zone_edges, cell), "located_nodes")

    @cached_property
    def simplified_roads(self) -> DataFrame:
        """id_zona and the edges of each zone's simplified graph."""
        edges = road_graph.within_zones(fixture.fixture_road_graph(self.spark, self.sf_dir)[0], self.located_nodes)
        simple, _, _ = road_graph.simplify(edges)
        zone = self.located_nodes.select(F.col("id_nodo").alias("nodo_a"), "id_zona")
        return self._write(simple.join(zone, "nodo_a").select("id_zona", "id_arista", "nodo_a", "nodo_b", "metros", "tramos"), "simplified_roads")

    # -- silver ----------------------------------------------------------
    @cached_property
    def silver_frames(self) -> silver_plan.SilverFrames:
        return silver_plan.build_silver(
            self.documents, self.geometry, self.cfg.thresholds, materialize=self._cut if self.materialize else None
        )

    @cached_property
    def silver(self) -> DataFrame:
        """Silver fact as a stage table.

        The date-partitioned sink (``silver.write_silver``) is the layout for
        data spanning weeks or months; the driver's fixture spreads a few
        rows over ~2,500 ship dates, which would turn it into thousands of
        tiny files, so the stage table here is unpartitioned.
        """
        return self._write(self.silver_frames.silver, "silver")

    @property
    def _silver_rows(self) -> DataFrame:
        """Silver as its table where that is written, else as its projection of the clean trips."""
        return self.__dict__.get("silver", self.silver_frames.silver)

    def write_quarantine(self) -> dict:
        """Write the quarantine and return the quality counts observed while doing so.

        The counts come from an ``Observation`` on the same pass, so the
        report costs no extra scan.
        """
        tagged, obs = silver_plan.quality_observation(self.silver_frames.tagged)
        path = scratch_path(self.spark, "cuarentena")
        silver_plan.write_quarantine(tagged.filter("motivo_rechazo IS NOT NULL"), path)
        self.paths["cuarentena"] = path
        return obs.get

    # -- gold ------------------------------------------------------------
    # Dimensions and the keyed fact are stage tables before the cast to the gold
    # schema: the conformance report reads them, the fact is keyed from them.
    @cached_property
    def dim_tiempo_raw(self) -> DataFrame:
        return self._write(dims.dim_tiempo(self._silver_rows), "dim_tiempo_raw", single_file=True)

    @cached_property
    def dim_operador_raw(self) -> DataFrame:
        return self._write(dims.dim_operador(self._silver_rows), "dim_operador_raw", single_file=True)

    @cached_property
    def fact_keyed(self) -> DataFrame:
        """Keyed trips before the cast to the gold schema, for several readers."""
        return self._write(self._keyed_rows, "fact_keyed")

    @property
    def _keyed_rows(self) -> DataFrame:
        """Keyed trips for one reader.

        The de-duplicated trips are numbered, so that shuffle holds their source fields alone; silver is a projection
        of the numbered rows with broadcast lookups, and neither it nor this frame is written.
        """
        frames = self.silver_frames
        trips = silver_plan.clean_trips(gold_plan.numbered_trips(frames.once, self.cfg.key_prefix_hex))
        silver = silver_plan.enriched(trips, frames.corridors, self.geometry)
        return gold_plan.with_dimension_keys(silver, self.dim_tiempo_raw, self.dim_operador_raw)

    @property
    def fact_rows(self) -> DataFrame:
        """The keyed trips as their table where that is written, else as `_keyed_rows`."""
        return self.fact_keyed if "fact_keyed" in self.__dict__ else self._keyed_rows

    @property
    def gold_raw(self) -> dict[str, DataFrame]:
        return {
            "dim_zona": self.dim_zona, "dim_tiempo": self.dim_tiempo_raw,
            "dim_operador": self.dim_operador_raw, "fact_servicio": self.fact_keyed,
        }

    def _gold(self, name: str, df: DataFrame) -> DataFrame:
        """One conformed gold table, written and read back."""
        rows = conform(df, schemas.GOLD[name]).rows
        return gold_plan.write_table(rows, scratch_path(self.spark, "gold"), name) if self.materialize else rows

    @cached_property
    def gold_dim_zona(self) -> DataFrame:
        return self._gold("dim_zona", self.dim_zona)

    @cached_property
    def gold_dim_tiempo(self) -> DataFrame:
        return self._gold("dim_tiempo", self.dim_tiempo_raw)

    @cached_property
    def gold_dim_operador(self) -> DataFrame:
        return self._gold("dim_operador", self.dim_operador_raw)

    @cached_property
    def gold_fact(self) -> DataFrame:
        """The conformed fact, written with its declared types."""
        if not self.materialize or "fact_keyed" in self.__dict__:
            return self._gold("fact_servicio", self.fact_keyed)
        rows = gold_plan.conformed_fact(self._silver_rows, self.dim_tiempo_raw, self.dim_operador_raw, self.cfg.key_prefix_hex)
        return gold_plan.write_table(rows, scratch_path(self.spark, "gold"), "fact_servicio")

    @property
    def gold(self) -> gold_plan.GoldFrames:
        """All four gold tables (each built and written once, on first use)."""
        return gold_plan.GoldFrames(
            dim_zona=self.gold_dim_zona,
            dim_tiempo=self.gold_dim_tiempo,
            dim_operador=self.gold_dim_operador,
            fact_servicio=self.gold_fact,
        )

    # -- physical layouts -------------------------------------------------
    @cached_property
    def layouts(self) -> dict[str, DataFrame]:
        """The gold fact written twice: range-partitioned and sorted, and plain."""
        fact = self.gold_fact
        opt = layout.write_optimised(self.spark, fact)
        ctl = layout.write_control(self.spark, fact)
        for t in (opt, ctl):
            layout.analyze(self.spark, t)
        return {layout.OPTIMISED: self.spark.table(opt), layout.CONTROL: self.spark.table(ctl)}

    @cached_property
    def dimension_tables(self) -> dict[str, DataFrame]:
        """Date and zone dimensions as analysed catalog tables."""
        out = {}
        for name in ("dim_tiempo", "dim_zona"):
            t = layout.write_dimension_table(self.spark, getattr(self, f"gold_{name}"), name)
            layout.analyze(self.spark, t)
            out[name] = self.spark.table(t)
        return out


_CACHE: dict[tuple[str, str], Warehouse] = {}


def warehouse_for(spark: SparkSession, sf_dir: str) -> Warehouse:
    """One warehouse per (application, input folder), reused across queries."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = Warehouse(spark, sf_dir)
    return _CACHE[key]

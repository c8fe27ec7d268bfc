"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from ..sources.tables import read_table

# The white space of every text contract: blank, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"



def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Bytes of rows that go to a Python worker at a time: a batch is held by the executor and by the worker, in several copies.
BATCH_BYTES = 2 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about `BATCH_BYTES` from now on, however long they are (a row above that goes alone)."""
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """`bound_batches` for what runs inside; the session's setting is as before afterwards."""
    before = spark.conf.get(_BATCH_SETTING, None)
    bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before) if before is not None else spark.conf.unset(_BATCH_SETTING)


# How to empty the caches that a module keeps in a worker.
_caches: dict[str, Callable[[], None]] = {}


def worker_cache(module: str, clear: Callable[[], None]) -> None:
    """Name the cache of a module; a worker empties it when it runs another module's function."""
    _caches[module] = clear


def _clear_others(module: str) -> None:
    for name, clear in _caches.items():
        if name != module:
            clear()


def _release() -> None:
    """Freed memory back to the system (where the C library can): workers are reused, and what one operator held would stay beside the next one's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(function: Callable) -> Callable:
    """The function, without the other modules' caches in its worker, and with its freed memory given back at the end of each task."""
    module = function.__module__

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _clear_others(module)
        try:
            yield from function(batches)
        finally:
            _release()

    return run


_shipped: set[str] = set()


def map_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path, and its workers' memory `released`."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), "viaduct-workers.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        file = os.path.join(folder, name)
                        archive.write(file, os.path.relpath(file, os.path.dirname(top)))
        context.addPyFile(path)
    return df.mapInArrow(released(function), schema)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def python_strings(column: pa.Array) -> list[str]:
    """Arrow strings as Python strings, null as empty."""
    return [x if x is not None else "" for x in column.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def arrow_rows(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of the named columns as Python values."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over undirected links (a, b).

    Large-star / small-star rounds: every round is one hash aggregate per star
    over the current links, written to the shared folder; rounds grow with
    the logarithm of a component's size. The rounds end when every link leads from a node
    to a root: no node has two links, and no link leads to a node that has one. Nodes without a link don't appear.
    """
    edges = staged(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc"
    )
    while True:
        lower = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        inner = lower.where("n > 1").select("u").unionByName(lower.join(edges.select(F.col("v").alias("u")), "u", "left_semi").select("u"))
        if inner.isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: neighbours above the node move to the smallest neighbour.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # Small star: neighbours below the node, and the node, move to the smallest of them.
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(floor, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = staged(small.where("u <> v").distinct(), "cc")


def joined_components(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) after more links (a, b): only the links between different components go through rounds."""
    own = links.join(components.toDF("a", "ra"), "a", "left").join(components.toDF("b", "rb"), "b", "left")
    own = own.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    moved = staged(connected_components(own), "cc-moved").toDF("component", "to")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).select("node", F.col("node").alias("component"))
    every = components.unionByName(ends).groupBy("node").agg(F.min("component").alias("component"))
    return every.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))

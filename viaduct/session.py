"""Session settings the pipeline relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


# Settings every job of the pipeline expects. UTC matters for correctness:
# trip timestamps are wall-clock values and hour/date are taken in UTC.
PIPELINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a sort-merge join into a broadcast only after it has measured
    # the small side at run time; beyond this size the shuffle join stays.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # Corridor sketches are hash-aggregated up to this many groups per task
    # (the default of 128 would sort the trips).
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    # Stored hashes are hexadecimal text, which the default (snappy) leaves at full length.
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(
    master: str | None = None,
    app_name: str = "viaduct",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings.

    ``shuffle_partitions`` is only set when given: on a cluster the job's
    configuration sizes it to the data (AQE then coalesces small partitions
    but never splits a large one, so it must start high enough).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(PIPELINE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_pipeline_conf(spark)
    return spark


def ensure_pipeline_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the operators assume (idempotent)."""
    for key, value in PIPELINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    This is the shared path named by ``spark.checkpoint.dir``. Only a local
    master may go without that setting (tests): a machine-local folder is made.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="viaduct-ckpt-")
    context.setCheckpointDir(configured)
    return context._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"

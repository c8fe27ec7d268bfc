"""Incremental bronze ingestion with Structured Streaming.

A file stream watches the raw folder; every new ``{service}_tripdata_*.parquet``
file is ingested once, tracked by the stream's checkpoint. Each micro-batch
hands its new file names to the batch loader (`sources.bronze.scan_trip_files` and
`to_documents`), so stream and batch build the same documents whatever
columns and types a file has. A batch writes its own ``lote=<id>`` folder
and overwrites it when it is run again, so a restarted stream neither loses nor repeats
documents. ``availableNow`` processes what is there and stops, so the job can be
scheduled like a batch job.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..sources import bronze


def read_stream_store(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Documents of all batches; columns that only some files have are NULL in the others."""
    return spark.read.option("mergeSchema", True).parquet(bronze_path).select("payload", "_ingesta")


def start_bronze_stream(
    spark: SparkSession,
    raw_dir: str,
    bronze_path: str,
    checkpoint: str,
    service: str = config.TIPO_SERVICIO,
    files_per_trigger: int = 1,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination`` to wait).

    ``checkpoint`` must be a lasting shared folder: it is what makes a later
    run skip the files already ingested.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        # At most ``files_per_trigger`` names.
        files = sorted(unquote(r["path"]) for r in batch.select("path").distinct().collect())
        if files:
            docs = bronze.to_documents(bronze.scan_trip_files(spark, files))
            bronze.write_documents(docs, f"{bronze_path.rstrip('/')}/lote={batch_id}")

    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", f"{service}_tripdata_*.parquet")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(raw_dir)
        .select(F.col("path"))
    )
    writer = names.writeStream.foreachBatch(ingest).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

"""Incremental hourly ingest of landing files as a Structured Streaming query.

The file source tracks which landing files were already processed in its
checkpoint, and the parquet file sink commits each micro-batch atomically
through its metadata log, so a rerun (or a retried batch after an executor
loss) neither skips nor duplicates files. ``trigger(availableNow=True)``
processes everything that has landed and stops, which suits an hourly
schedule; a long-running trigger works with the same code.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from marketlens.schemas import landing_with_partitions
from marketlens.sources.footers import landing_manifest
from marketlens.sources.landing import cluster_for_write, landing_files

#: Landing files below so many bytes are small: rows of several are brought together before they are written.
SMALL_FILE = 1 << 20


def small_files(spark: SparkSession, base: str, entity: str, below: int = SMALL_FILE) -> bool:
    """Whether at least half of an entity's landing files are below so many bytes (by a listing; nothing landed yet: True)."""
    half = landing_manifest(spark, base, entity).agg(F.percentile_approx("size", 0.5)).first()[0]
    return half is None or half < below


def stream_landing(spark: SparkSession, base: str, entity: str, sink: str, checkpoint: str,
                   available_now: bool = True, max_files_per_trigger: int | None = 5000, small_file: int = SMALL_FILE) -> StreamingQuery:
    """Start the ingest of an entity's landing files, in either layout, into a date-partitioned parquet table.

    ``max_files_per_trigger`` bounds each micro-batch (about a month of hourly
    region files by default), so a large backlog is processed as several
    committed batches instead of one; ``availableNow`` honours the bound.

    Rows of small landing files (:func:`small_files`, ``small_file`` bytes) are clustered by date before they are written. Larger ones
    are written by the tasks that read them, without a shuffle: a file holds one date, so a task writes at most as many
    files as it reads pieces of files.
    """
    reader = spark.readStream.schema(landing_with_partitions(entity))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    root, file = landing_files(spark, base, entity)
    if file:  # the generator's layout: one file per entity and hour folder
        reader = reader.option("basePath", root)
        src = reader.parquet(f"{root}/region=*/date=*/hour=*{file}")
    else:
        src = reader.parquet(root)
    out = src.select("*",
                     F.col("_metadata.file_path").alias("_source_file"),
                     F.current_timestamp().cast("timestamp_ntz").alias("_loaded_at"))
    # The raw table is partitioned by landing date (hourly partitions would
    # multiply small files). Each micro-batch of small files is clustered by date:
    # few files per date, and a date holding most of a backlog is still written
    # by several tasks.
    clustered = cluster_for_write(out, ("date",)) if small_files(spark, base, entity, small_file) else out
    w = (clustered.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .partitionBy("date").outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink)


def ingested_schema(entity: str) -> StructType:
    """Schema of the raw table the ingest writes (landing columns + lineage)."""
    return StructType(list(landing_with_partitions(entity).fields)
                      + [StructField("_source_file", StringType()), StructField("_loaded_at", TimestampNTZType())])


def run_ingest(spark: SparkSession, base: str, entity: str, sink: str, checkpoint: str) -> None:
    """Run one availableNow ingest to completion."""
    q = stream_landing(spark, base, entity, sink, checkpoint, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))

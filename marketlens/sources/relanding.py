"""Incremental ingest that follows the landing: new, re-landed and withdrawn files.

A writer's retry puts an hour's file down again under its own name, which a file stream, knowing names only, never reads
again. Here a ledger holds (path, size, modified) of every file that the table was built from. Each run joins it with
the listing and replaces just the hours whose files changed, from all files that those hours now have.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlens.session import unique_path
from marketlens.sources.footers import landing_manifest
from marketlens.sources.landing import read_files, with_audit
from marketlens.sources.publish import PublishedTable

HOUR = ("date", "hour")
LEDGER = "region string, date string, hour string, path string, size bigint, modified timestamp"


def changed_hours(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """(date, hour) in which a file is new, has another size or time, or is gone, with how many of each."""
    now = listing.select("path", "date", "hour", F.struct("size", "modified").alias("now"))
    was = ledger.select("path", F.col("date").alias("old_date"), F.col("hour").alias("old_hour"), F.struct("size", "modified").alias("was"))
    both = now.join(was, "path", "full").filter(~F.col("now").eqNullSafe(F.col("was")))
    return both.groupBy(F.coalesce("date", "old_date").alias("date"), F.coalesce("hour", "old_hour").alias("hour")).agg(
        F.count_if(F.col("was").isNull()).alias("new_files"), F.count_if(F.col("now").isNotNull() & F.col("was").isNotNull()).alias("changed_files"),
        F.count_if(F.col("now").isNull()).alias("gone_files"))


def ingest_changes(spark: SparkSession, base: str, entity: str, table: str, loaded_at: str) -> list[tuple[str, str]]:
    """Bring the published table at ``table`` up to the landing; returns the hours that were replaced.

    The ledger is at ``{table}_ledger``. It follows the table: a run that ends between the two replaces the same hours
    again next time. Rows carry ``_source_file`` and ``_loaded_at``; those of other hours stay as they are. The driver holds the
    changed hours and the paths of their files.
    """
    files = unique_path(spark, "listing")
    landing_manifest(spark, base, entity).select("region", "date", "hour", "path", "size", "modified").write.parquet(files)
    listing = spark.read.schema(LEDGER).parquet(files)  # one listing for the whole run, whatever lands meanwhile
    data, ledger = PublishedTable(spark, table), PublishedTable(spark, f"{table}_ledger")
    known = ledger.read(schema=listing.schema)
    hours = [(r.date, r.hour) for r in changed_hours(listing, known).select(*HOUR).collect()]
    if not hours:
        return []
    here = spark.createDataFrame(hours, "date string, hour string")
    now = listing.join(F.broadcast(here), list(HOUR), "left_semi")  # one row per changed hour, held by the driver already
    rows = with_audit(read_files(spark, base, entity, [r.path for r in now.select("path").collect()]), loaded_at)
    replaced = [{"date": d, "hour": h} for d, h in hours]
    data.publish(rows, HOUR, replaced)
    ledger.publish(now.select(*listing.columns), HOUR, replaced)
    return sorted(hours)


def follow_landing(spark: SparkSession, base: str, entity: str, table: str, checkpoint: str, every: str = "1 minute") -> StreamingQuery:
    """:func:`ingest_changes` each time a streaming trigger fires, with the trigger's time as load time."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def run(batch: DataFrame, batch_id: int) -> None:
        at = batch.agg(F.max("timestamp").cast("string")).first()[0]
        if at is not None:
            ingest_changes(batch.sparkSession, base, entity, table, at)

    return ticks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()

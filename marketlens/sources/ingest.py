"""Batch ingest: landing files -> raw table partitions + load-audit rows.

The hourly job reads every region file of the hour in one scan, adds the lineage columns, and publishes the (date, hour)
partition of the raw table in one step: rerunning an hour (a retry, a backfill) replaces that hour instead of appending it
twice, and readers see it whole before and after (``sources.publish``). Rows are counted in flight with an ``Observation`` (no
second pass over the written data).
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.session import at_once
from marketlens.sources.adapter import RAW_ENTITIES
from marketlens.sources.landing import read_foreign, read_foreign_hour, read_landing, with_audit
from marketlens.sources.publish import PublishedTable

HOUR = ("date", "hour")
#: What names a run's audit rows of an hour: a rerun replaces its own.
AUDIT_KEY = ("entity", "load_date", "load_hour", "dag_run_id")


def ingest_hour(spark: SparkSession, landing_base: str, raw_path: str, entity: str, date: str, hour: str,
                run_id: str, loaded_at: str, foreign: bool = False) -> tuple[int, DataFrame]:
    """Load one hour into the published table at ``raw_path``; returns (rows written, audit rows per region).

    ``foreign``: files whose types may differ from the declared ones (:func:`read_foreign_hour`).

    The audit lists the regions that the batch itself has, listed or not, NULL included (a bounded set that is counted
    before the write); the rows written per region are observed during the write, so the audit describes exactly what
    this run wrote, even if a later rerun replaces the partition.
    """
    if foreign:
        landed = read_foreign_hour(spark, landing_base, entity, date, hour).withColumn(
            "_loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    else:
        landed = with_audit(read_landing(spark, landing_base, entity, date, hour), loaded_at)
    expected = [(r.region, r.n) for r in landed.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()]
    obs = Observation(f"ingest_{entity}_{date}_{hour}")
    metrics = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(F.col("region").eqNullSafe(F.lit(r))).alias(f"r{i}") for i, (r, _) in enumerate(expected)]
    PublishedTable(spark, raw_path).publish(landed, HOUR, [{"date": date, "hour": hour}], observe=(obs, metrics))
    got = obs.get
    rows = [(r, n, int(got.get(f"r{i}", 0))) for i, (r, n) in enumerate(expected)]
    audit = spark.createDataFrame(rows, "region string, s3_expected_rows bigint, sf_actual_rows bigint").select(
        F.expr("uuid()").alias("load_id"), F.lit(run_id).alias("dag_run_id"),
        F.lit(date).cast("date").alias("load_date"), F.lit(hour).alias("load_hour"), "region", F.lit(entity).alias("entity"),
        "s3_expected_rows", "sf_actual_rows", F.current_timestamp().alias("loaded_at"))
    return int(got.get("rows", 0)), audit


def append_audit(spark: SparkSession, path: str, audit: DataFrame, entity: str, date: str, hour: str, run_id: str) -> None:
    """Keep the audit rows of one run, hour and entity in the published audit table at ``path``, exactly once.

    A rerun under the same run id replaces its own rows, and leaves none if its hour has no region any more.
    """
    own = {"entity": entity, "load_date": date, "load_hour": hour, "dag_run_id": run_id}
    PublishedTable(spark, path).publish(audit, AUDIT_KEY, [own])


def ingest_history(spark: SparkSession, landing_base: str, raw_base: str, entities=RAW_ENTITIES, foreign: bool = False) -> None:
    """Backfill: every landed hour of each entity into the published table ``{raw_base}/{entity}``, one job per entity, all at the same time.

    A batch's ``_loaded_at`` is the end of its landing hour, as the hourly job would have set it, so later loads of a
    customer or product stay later. Rerunning replaces the same (date, hour) partitions. ``foreign``: files whose types may
    differ from the declared ones and from file to file (:func:`read_foreign`).
    """
    loaded = F.concat_ws(" ", "date", F.concat("hour", F.lit(":00:00"))).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")

    def ingest(entity: str) -> None:
        if foreign:
            landed = read_foreign(spark, landing_base, entity).withColumn("_loaded_at", loaded)
        else:
            landed = with_audit(read_landing(spark, landing_base, entity), loaded)
        PublishedTable(spark, f"{raw_base.rstrip('/')}/{entity}").publish(landed, HOUR)

    at_once(spark, [partial(ingest, entity) for entity in entities])

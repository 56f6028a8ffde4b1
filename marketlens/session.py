"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Defaults a cluster job should run with.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where a later operator then needs another shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Shuffled bytes (compressed) that adaptive execution gives a task where the session doesn't say.
TASK_BYTES = "32m"

# Settings for the large-cluster target (~100 TB input, ~1000 executors). Shuffle
# width is set high and AQE coalesces small partitions at run time, so the same
# job is efficient for a quiet hour and for a full-history rebuild; skew
# handling splits any shuffle partition several times the median size.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.files.openCostInBytes": "8m",
    # broadcast only what the runtime measured as small; no planner guesses on big tables
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "64",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply the large-cluster SQL settings to a running session (runtime-settable keys only)."""
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # noqa: BLE001 - static confs must be given at launch
            pass


def build_session(master: str = "local[*]", app: str = "marketlens",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    b = SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Pin the settings results depend on and size file listing.

    This overwrites the session's time zone (UTC) and partition overwrite mode (dynamic), whatever was set.

    Many small landing files (one per region-hour) are listed by a Spark job
    with one task per path by default; two tasks per core list them with far
    less scheduling overhead and still scale with the cluster.

    Rows take ten times the bytes in a task's sorts and hash tables that they take in a compressed shuffle, so adaptive
    execution joins shuffle partitions up to :data:`TASK_BYTES` only, unless the session has a setting of its own.
    """
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark.conf.get(advisory, None) is None:
        spark.conf.set(advisory, TASK_BYTES)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(max(8, 2 * spark.sparkContext.defaultParallelism)))
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform to a shared (HDFS/object-store)
    folder and is only read here; without it an error is raised. Only a plain
    local session (one process, as in tests) gets a private folder.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            d = None
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="marketlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "marketlens", *parts])


def unique_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder, for one run's output."""
    return shared_path(spark, *parts, uuid.uuid4().hex)


def local_scratch() -> str:
    """Fresh private folder; for tests only, never for cluster jobs."""
    return tempfile.mkdtemp(prefix="marketlens-", dir=os.environ.get("TMPDIR", "/tmp"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside are removed when it ends, not when the driver happens to collect its garbage.

    For queries that run once, as writes do: a DataFrame that is run again would have to make them anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def at_once(spark: SparkSession, jobs: Sequence[Callable[[], object]]) -> list:
    """Run independent Spark jobs at the same time, so that one's last tasks and small stages don't leave the cluster idle.

    Returns their results in order; the first one's error is raised after all have ended.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [f.result() for f in started]

"""Hourly landing files: partitioned scan, audit columns, typed load, sinks.

Two layouts: the generator's, ``{base}/region=R/date=YYYY-MM-DD/hour=HH/{entity}.parquet``, and this library's own sink,
``{base}/{entity}/region=R/date=YYYY-MM-DD/hour=HH/part-*.parquet``. Reads are a single glob scan with an explicit schema,
so Spark lists and plans every region file of an hour in parallel and prunes partitions from the path; there is no
per-file driver loop.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StructType

from marketlens.constants import SEED_REGIONS
from marketlens.schemas import LANDING, LOAD_AUDIT, PARTITION_COLUMNS, landing_with_partitions

PARTITION_DIR = r"(region=[^/]+/date=[^/]+/hour=[^/]+)"


def entity_path(base: str, entity: str) -> str:
    return f"{base.rstrip('/')}/{entity}"


def _globbed(spark: SparkSession, pattern: str) -> bool:
    p, fs = _fs_path(spark, pattern)
    return bool(fs.globStatus(p))


def landing_files(spark: SparkSession, base: str, entity: str) -> tuple[str, str]:
    """(root, file part) of an entity's landing: where region folders begin and what follows the hour folder.

    Raises FileNotFoundError if ``base`` has neither layout, so that a wrong path isn't read as an hour without data.
    """
    base = base.rstrip("/")
    if _globbed(spark, f"{base}/{entity}"):
        return f"{base}/{entity}", ""
    if _globbed(spark, f"{base}/region=*"):
        return base, f"/{entity}.parquet"
    raise FileNotFoundError(f"no landing of {entity} at {base}: neither {entity}/region=... nor "
                            f"region=.../date=.../hour=.../{entity}.parquet")


def read_landing(spark: SparkSession, base: str, entity: str, date: str = "*", hour: str = "*",
                 regions: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """Scan every region's ``entity`` files of one (date, hour), or the whole history, in either layout.

    One hour (the hourly job) is a glob over the region folders, and so are some regions; the whole history of the
    library's own layout reads the entity root with partition discovery. Any region / date / hour predicate becomes a
    partition filter. A region whose file is absent is simply not matched (A4); if nothing matches an hour, an empty frame
    with the declared schema is returned. A base without any landing raises (:func:`landing_files`).
    """
    root, file = landing_files(spark, base, entity)
    schema = schema or landing_with_partitions(entity)
    if regions is not None and not regions:
        return spark.createDataFrame([], schema)
    if date == "*" and hour == "*" and regions is None and not file:
        return spark.read.schema(schema).parquet(root)
    region = "*" if regions is None else "{" + ",".join(regions) + "}"
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(
            f"{root}/region={region}/date={date}/hour={hour}{file}")
    except AnalysisException as e:  # the glob matches nothing
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_files(spark: SparkSession, base: str, entity: str, paths: list[str]) -> DataFrame:
    """Some landed files of an entity, by path, in the declared schema."""
    schema = landing_with_partitions(entity)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", landing_files(spark, base, entity)[0]).parquet(*paths)


def with_audit(df: DataFrame, loaded_at) -> DataFrame:
    """Add lineage: ``_source_file`` (the file's whole path) and one ``_loaded_at`` per run."""
    loaded = loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at).cast("timestamp_ntz")
    if not df.inputFiles():  # nothing landed: no file to name
        return df.select("*", F.lit(None).cast("string").alias("_source_file"), loaded.alias("_loaded_at"))
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"), loaded.alias("_loaded_at"))


def partition_dir(source_file: str | Column = "_source_file") -> Column:
    """The region, date and hour folders of a file's path."""
    return F.regexp_extract(source_file, PARTITION_DIR, 1)


def _typed(name: str, kind: DataType) -> Column:
    if isinstance(kind, IntegralType):  # fractions are rounded half away from zero, as the source's warehouse loads them
        return F.expr(f"try_cast(round(try_cast(`{name}` as decimal(38,10)), 0) as {kind.simpleString()})")
    return F.expr(f"try_cast(`{name}` as {kind.simpleString()})")


def flagged_load(df: DataFrame, schema: StructType) -> DataFrame:
    """Project + try_cast to ``schema`` (case-insensitive names), other columns kept, and ``_rejected``.

    A row is rejected when some non-null input does not convert. One scan gives loaded and rejected rows.
    """
    lower = {c.lower(): c for c in df.columns}
    casts, rejected = [], F.lit(False)
    for f in schema.fields:
        src = lower.get(f.name.lower())
        if src is None:
            casts.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        typed = _typed(src, f.dataType)
        casts.append(typed.alias(f.name))
        rejected = rejected | (F.col(src).isNotNull() & typed.isNull())
    declared = {f.name.lower() for f in schema.fields}
    keep = [c for c in df.columns if c.lower() not in declared]
    return df.select(*casts, *[F.col(c) for c in keep], rejected.alias("_rejected"))


def typed_load(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(loaded rows in ``schema``, rejected rows as they came), two lazy plans over ``df``."""
    flag = flagged_load(df.withColumn("_as_read", F.struct("*")), schema)
    return flag.filter("NOT _rejected").drop("_rejected", "_as_read"), flag.filter("_rejected").select("_as_read.*")


def seed_regions(spark: SparkSession) -> DataFrame:
    """The six-row region seed (bounded: safe to broadcast)."""
    return spark.createDataFrame(SEED_REGIONS, "region string, continent string, timezone_offset int")


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("region string, continent string, timezone_offset int").option("header", True).csv(path)


def with_partition_columns(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    return df.withColumn("date", F.date_format(ts_col, "yyyy-MM-dd")).withColumn("hour", F.date_format(ts_col, "HH"))


def cluster_for_write(df: DataFrame, partitions=PARTITION_COLUMNS) -> DataFrame:
    """Cluster rows by output partition without letting one partition become one task.

    The rebalance hint keeps each output partition's rows in few tasks (few files); adaptive execution, which knows the
    sizes from the shuffle itself, splits a partition holding a large share of the rows over several tasks and joins small
    ones, so the rows are computed once, and rows that are read together stay together and compress well. Without adaptive
    execution nothing would be split: then a range partitioning on (partition columns, row hash) does the same, at the price
    of a pass that samples the rows.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", *[F.col(f"`{c}`") for c in partitions])
    return df.repartitionByRange(*partitions, F.xxhash64(*[F.col(c) for c in df.columns]))


def write_hour(df: DataFrame, path: str, partitions=PARTITION_COLUMNS, max_records_per_file: int = 1_000_000) -> None:
    """Idempotent partitioned write: reruns replace only the partitions they produce."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    (cluster_for_write(df, partitions)
     .write.mode("overwrite")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*partitions)
     .parquet(path))


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


COMMIT_MARKER = "_COMMITTED"


def path_complete(spark: SparkSession, path: str) -> bool:
    """True when a write at ``path`` finished (its commit marker exists)."""
    p, fs = _fs_path(spark, path.rstrip("/") + "/" + COMMIT_MARKER)
    return bool(fs.exists(p))


def mark_complete(spark: SparkSession, path: str) -> None:
    """Drop the commit marker after a successful write (dynamic overwrite leaves no _SUCCESS)."""
    p, fs = _fs_path(spark, path.rstrip("/") + "/" + COMMIT_MARKER)
    fs.create(p, True).close()


def load_audit(flagged: DataFrame, run_id: str, entity: str) -> DataFrame:
    """Per (load_date, region): rows expected (all that landed) and rows loaded, one pass over :func:`flagged_load`."""
    return flagged.groupBy(F.col("date").cast("date").alias("load_date"), "region").agg(
        F.count(F.lit(1)).alias("s3_expected_rows"), F.count_if(~F.col("_rejected")).alias("sf_actual_rows")).select(
        F.lit(run_id).alias("dag_run_id"), "load_date", "region", F.lit(entity).alias("entity"), "s3_expected_rows", "sf_actual_rows")


__all__ = ["LANDING", "LOAD_AUDIT", "read_landing", "read_files", "with_audit", "typed_load", "seed_regions", "write_hour",
           "load_audit", "flagged_load", "landing_files", "partition_dir", "nanos_to_timestamp", "read_foreign", "read_foreign_hour", "path_complete", "mark_complete", "with_partition_columns",
           "read_seed_csv", "cluster_for_write"]


def nanos_to_timestamp(nanos: Column) -> Column:
    """Whole nanoseconds since 1970 as a naive UTC timestamp, cut to microseconds in whole-number arithmetic."""
    return F.timestamp_micros(F.call_function("div", nanos, F.lit(1000).cast("bigint"))).cast("timestamp_ntz")


def read_foreign(spark: SparkSession, base: str, entity: str, date: str = "*", hour: str = "*",
                 regions: list[str] | None = None) -> DataFrame:
    """Landing files of a foreign writer (e.g. pandas/pyarrow), one hour or the whole history, in the declared schema; either layout.

    Such files may carry nanosecond timestamps (read as whole numbers, then ns -> us), a column that is NULL in every row
    of a file and was therefore written with a placeholder type, or other number types. Tasks read the files' footers; files
    whose columns have the same types are read in one scan with these types, so there are as many scans as different
    schemas, whatever the number of files, hours and regions. Columns are matched by name, whatever its case; a missing one is
    NULL. Every region folder is read. The driver holds the files' paths, as it does to plan the scans.
    """
    from marketlens.sources.footers import footers, landing_manifest

    declared, root = LANDING[entity], landing_files(spark, base, entity)[0]
    files = landing_manifest(spark, base, entity, date, hour)
    if regions is not None:
        files = files.filter(F.col("region").isin(list(regions)))
    groups: dict[tuple, list[str]] = {}
    wanted = [f.name for f in declared.fields if f.name != "region"]
    for path, kinds in footers(files, wanted).select("path", "kinds").collect():
        groups.setdefault(tuple(kinds), []).append(path)
    parts = []
    for kinds, paths in sorted(groups.items()):
        have = {k.split(":", 1)[0].lower(): tuple(k.split(":", 1)) for k in kinds}
        fields = [(name, "bigint" if kind == "nanos" else kind) for name, kind in have.values() if kind != "none"]
        schema = ", ".join(f"`{name}` {kind}" for name, kind in [*fields, *((p, "string") for p in PARTITION_COLUMNS)])
        df = spark.read.schema(schema).option("basePath", root).parquet(*sorted(paths))
        cols = []
        for f in declared.fields:
            name, kind = have.get(f.name.lower(), (f.name, "none"))
            if f.name == "region":
                cols.append(F.col("region"))
            elif kind == "none":
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif kind == "nanos":
                cols.append(nanos_to_timestamp(F.col(name)).cast(f.dataType).alias(f.name))
            else:
                cols.append(F.col(name).cast(f.dataType).alias(f.name))
        if "region" not in declared.fieldNames():
            cols.append(F.col("region"))
        parts.append(df.select(*cols, "date", "hour", F.col("_metadata.file_path").alias("_source_file")))
    if not parts:
        return spark.createDataFrame([], landing_with_partitions(entity)).withColumn("_source_file", F.lit(None).cast("string"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_foreign_hour(spark: SparkSession, base: str, entity: str, date: str, hour: str,
                      regions: list[str] | None = None) -> DataFrame:
    """:func:`read_foreign` of one hour."""
    return read_foreign(spark, base, entity, date, hour, regions)

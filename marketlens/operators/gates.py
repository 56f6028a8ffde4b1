"""Runtime gates: freshness, load counts, landing completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.constants import FRESHNESS_ERROR_HOURS, FRESHNESS_WARN_HOURS, REGIONS
from marketlens.sources.footers import footers


def _ts(now) -> F.Column:
    return F.lit(now).cast("timestamp_ntz")


def freshness(sources: Mapping[str, DataFrame], now: str, loaded_col: str = "_loaded_at",
              warn_hours: int = FRESHNESS_WARN_HOURS, error_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Per source: newest load time, age in hours at ``now`` and pass / warn / error.

    ``now`` is injected (not the wall clock) so results are reproducible.
    """
    parts = [df.agg(F.max(loaded_col).alias("max_loaded_at")).select(F.lit(name).alias("source"), "max_loaded_at")
             for name, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return _graded(u, now, warn_hours, error_hours)


def recent_rows(df: DataFrame, now: str, hours: int = 2, loaded_col: str = "_loaded_at") -> DataFrame:
    """Rows loaded within ``hours`` before ``now``; one row (n_recent, passed).

    A filter on the load time, so that a stored table skips the files and row groups of its history.
    """
    since = _ts(now) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return df.filter(F.col(loaded_col) >= since).agg(F.count(F.lit(1)).alias("n_recent")).select(
        "n_recent", (F.col("n_recent") > 0).alias("passed"))


def _graded(newest: DataFrame, now: str, warn_hours: int, error_hours: int) -> DataFrame:
    """Adds age_hours at ``now`` and pass / warn / error to (source, max_loaded_at)."""
    # wall-clock difference of naive timestamps, independent of the session time zone
    age = F.expr(f"timestampdiff(MICROSECOND, max_loaded_at, TIMESTAMP_NTZ '{now}')") / 3.6e9
    return newest.withColumn("age_hours", age).withColumn(
        "status", F.when(F.col("max_loaded_at").isNull(), "error").when(age > error_hours, "error")
        .when(age > warn_hours, "warn").otherwise("pass"))


def gates_from_footers(tables: Mapping[str, DataFrame], now: str, loaded_col: str = "_loaded_at",
                       warn_hours: int = FRESHNESS_WARN_HOURS, error_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """Per stored table: n_rows, newest load time, its age and pass / warn / error, from Parquet footers.

    ``tables`` are scans of Parquet files without filters. Their footers hold row counts and the largest load time of each row
    group, so no row is read; only files without such statistics have that one column read. One small row per file meets in
    the aggregate.
    """
    spark = next(iter(tables.values())).sparkSession
    parts = []
    for name, df in tables.items():
        paths = [unquote(p) for p in df.inputFiles()]  # the planner's own list
        files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(2000, len(paths) // 64 + 1))
        parts.append(footers(files, [], loaded_col).withColumn("source", F.lit(name)))
    feet = reduce(lambda a, b: a.unionByName(b), parts).groupBy("source").agg(
        F.sum("n_rows").alias("n_rows"), F.max("newest").alias("newest"), F.collect_list(F.when(~F.col("known"), F.col("path"))).alias("unknown"))
    found = {r.source: r for r in feet.collect()}  # a row per table
    rows = []
    for name, df in tables.items():
        r = found.get(name)
        newest = [None if r is None else r.newest]
        if r is not None and r.unknown:
            rest = spark.read.schema(df.select(loaded_col).schema).parquet(*r.unknown)
            newest.append(rest.agg(F.unix_micros(F.max(loaded_col).cast("timestamp"))).first()[0])
        rows.append((name, 0 if r is None else r.n_rows, max((x for x in newest if x is not None), default=None)))
    out = spark.createDataFrame(rows, "source string, n_rows bigint, newest bigint")
    out = out.select("source", "n_rows", F.timestamp_micros("newest").cast("timestamp_ntz").alias("max_loaded_at"))
    return _graded(out, now, warn_hours, error_hours)


def rows_by_load_date(tables: Mapping[str, DataFrame], loaded_col: str = "_loaded_at") -> DataFrame:
    """Row count per table and load date (a non-empty gate reads its date's row)."""
    parts = [df.groupBy(F.to_date(loaded_col).alias("load_date")).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "load_date", "n_rows") for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


def landed_hours(batches: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """(date, hour) of every hour asked for, ``since`` to ``until`` ("yyyy-MM-dd HH", both included).

    The range is the caller's, so an hour in which nothing landed is there too. Without a range, the hours that
    ``batches`` (region, date, hour) has.
    """
    if since is None or until is None:
        return batches.select("date", "hour").distinct()
    spark = batches.sparkSession
    span = spark.range(1).select(F.explode(F.sequence(
        F.lit(since + ":00:00").cast("timestamp_ntz"), F.lit(until + ":00:00").cast("timestamp_ntz"),
        F.expr("INTERVAL 1 HOUR"))).alias("t"))
    return span.select(F.date_format("t", "yyyy-MM-dd").alias("date"), F.date_format("t", "HH").alias("hour"))


def region_manifest(batches: DataFrame, expected: Sequence[str] = REGIONS, since: str | None = None,
                    until: str | None = None) -> DataFrame:
    """For every (date, hour) asked for: rows landed per expected region, and per other region that landed.

    ``present``: whether anything landed; ``expected``: whether the region is one of ``expected`` (a NULL or
    unlisted region is reported with false, not left out). See :func:`landed_hours` for the range.
    """
    counts = batches.groupBy("date", "hour", "region").agg(F.count(F.lit(1)).alias("n_rows"))
    grid = landed_hours(batches, since, until).select(
        "date", "hour", F.explode(F.array(*[F.lit(r) for r in expected])).alias("region")).withColumn("n_rows", F.lit(0).cast("long"))
    inside = counts.join(landed_hours(batches, since, until), ["date", "hour"], "left_semi").select("date", "hour", "region", "n_rows")
    j = grid.unionByName(inside).groupBy("date", "hour", "region").agg(F.sum("n_rows").alias("n_rows"))
    return j.select("date", "hour", "region", "n_rows", (F.col("n_rows") > 0).alias("present"),
                    F.coalesce(F.col("region").isin(list(expected)), F.lit(False)).alias("expected"))


def file_manifest(files: DataFrame, expected: Sequence[str] = REGIONS, since: str | None = None, until: str | None = None) -> DataFrame:
    """For every (date, hour) asked for: files landed per expected region, and per other region that landed any.

    ``files`` is a listing (region, date, hour, path, size). ``present`` says whether a file is there, with rows or without, so
    an empty file counts as landed and a folder without files doesn't. Otherwise as :func:`region_manifest`.
    """
    counts = files.groupBy("date", "hour", "region").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("n_bytes"))
    grid = landed_hours(files, since, until).select("date", "hour", F.explode(F.array(*[F.lit(r) for r in expected])).alias("region"))
    inside = counts.join(landed_hours(files, since, until), ["date", "hour"], "left_semi")
    j = grid.unionByName(inside, allowMissingColumns=True).groupBy("date", "hour", "region").agg(
        F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))
    return j.select("date", "hour", "region", "n_files", "n_bytes", (F.col("n_files") > 0).alias("present"),
                    F.coalesce(F.col("region").isin(list(expected)), F.lit(False)).alias("expected"))


def hour_completeness(batches: DataFrame, expected: Sequence[str] = REGIONS, since: str | None = None,
                      until: str | None = None) -> DataFrame:
    """Per (date, hour) asked for: expected regions landed, completeness flag, missing and unexpected regions.

    An hour with nothing at all is there with 0 regions if the range covers it; a NULL region is listed as ``null``.
    """
    m = region_manifest(batches, expected, since, until)
    name = F.coalesce("region", F.lit("null"))
    g = m.groupBy("date", "hour").agg(
        F.count_if(F.col("expected") & F.col("present")).alias("n_regions"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("expected") & ~F.col("present"), name))), ",").alias("missing_regions"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("expected"), name))), ",").alias("unexpected_regions"))
    return g.select("date", "hour", "n_regions", (F.col("n_regions") == len(expected)).alias("is_complete"),
                    "missing_regions", "unexpected_regions")


def non_empty_load(tables: Mapping[str, DataFrame], load_date: str, loaded_col: str = "_loaded_at") -> DataFrame:
    """Gate for one load date: rows loaded that day per table, ``passed`` when > 0.

    Each table contributes one row even when nothing was loaded (a global
    aggregate over an empty input still yields its row), so a missing load
    shows up as 0 rather than as an absent row.
    """
    d = F.lit(load_date).cast("date")
    parts = [df.filter(F.to_date(loaded_col) == d).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("table_name"), d.alias("load_date"), "n_rows") for name, df in tables.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.withColumn("passed", F.col("n_rows") > 0)

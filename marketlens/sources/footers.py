"""Landed files as rows: the listing, and what Parquet footers say without reading a row."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.landing import landing_files

# Functions sent to Python workers carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILES = "path string, size bigint, modified timestamp"


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, size, modified) of the Parquet files at a path or glob, however deep; contents aren't read."""
    try:
        df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(pattern)
    except AnalysisException as e:  # nothing there
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], FILES)
    return df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def landing_manifest(spark: SparkSession, base: str, entity: str, date: str = "*", hour: str = "*") -> DataFrame:
    """(region, date, hour, path, size, modified) of every landed file of an entity, in either layout, files without rows too."""
    root, file = landing_files(spark, base, entity)
    files = list_files(spark, f"{root}/region=*/date={date}/hour={hour}{file}")

    def part(name: str) -> Column:
        return F.regexp_extract("path", f"/{name}=([^/]+)/", 1).alias(name)

    return files.select(part("region"), part("date"), part("hour"), "path", "size", "modified")


def _kind(t: pa.DataType) -> str:
    """The Spark type that reads a column of this Arrow type; ``nanos`` for nanoseconds and ``none`` for a column of nulls."""
    if pa.types.is_null(t):
        return "none"
    if pa.types.is_timestamp(t):
        return "nanos" if t.unit == "ns" else "timestamp" if t.tz else "timestamp_ntz"
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    if pa.types.is_dictionary(t):
        return _kind(t.value_type)
    names = {"bool": "boolean", "int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "uint8": "smallint", "uint16": "int",
             "uint32": "bigint", "float": "float", "double": "double", "string": "string", "large_string": "string", "date32[day]": "date",
             "binary": "binary"}
    if str(t) not in names:
        raise TypeError(f"a landed column of type {t} can't be loaded")
    return names[str(t)]


def _open(path: str):
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    fs, name = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(name)


def _newest(meta: pq.FileMetaData, name: str) -> tuple[int | None, bool]:
    """(largest value of a timestamp column in microseconds, whether the footer tells it for all rows)."""
    best, known = None, True
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        c = next((group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema.lower() == name.lower()), None)
        if c is None or group.num_rows == 0:
            continue
        s = c.statistics
        if s is None or not s.has_min_max or c.physical_type != "INT64":
            known = known and s is not None and s.has_null_count and s.null_count == group.num_rows
            continue
        unit = str(s.logical_type).lower()
        raw = s.max_raw // 1000 if "nanos" in unit else s.max_raw * 1000 if "milli" in unit else s.max_raw
        best = raw if best is None else max(best, raw)
    return best, known


def footers(files: DataFrame, columns: Sequence[str], newest_of: str | None = None) -> DataFrame:
    """path, n_rows, kinds, newest, known of each file, read from its footer in tasks.

    kinds: ``name:type`` of those of ``columns`` that the file has, in their order, names as the file has them; newest: the largest
    value of the timestamp column ``newest_of`` in microseconds; known: false where a row group has no statistics of it.
    Paths need a scheme that Arrow's file systems know (file, hdfs, s3, gs).
    """
    names = [c.lower() for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"path": [], "n_rows": [], "kinds": [], "newest": [], "known": []}
            for path in b.column(0).to_pylist():
                with _open(path) as f:
                    p = pq.ParquetFile(f)
                    meta, have = p.metadata, {x.name.lower(): x for x in p.schema_arrow}
                newest, known = _newest(meta, newest_of) if newest_of else (None, True)
                out["path"].append(path)
                out["n_rows"].append(meta.num_rows)
                out["kinds"].append([f"{have[n].name}:{_kind(have[n].type)}" for n in names if n in have])
                out["newest"].append(newest)
                out["known"].append(known)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["path"], pa.string()), pa.array(out["n_rows"], pa.int64()), pa.array(out["kinds"], pa.list_(pa.string())),
                 pa.array(out["newest"], pa.int64()), pa.array(out["known"], pa.bool_())], list(out))

    return files.select("path").mapInArrow(run, "path string, n_rows bigint, kinds array<string>, newest bigint, known boolean")

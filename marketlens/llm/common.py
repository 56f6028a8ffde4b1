"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT_BYTES = 1 << 20
SPACES = b" \t\n\r\x0b\x0c"


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder in ``spark.checkpoint.dir``.

    Only a plain local session may leave that setting unset (tests); it then gets a private folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith(("local[", "local")) or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark, path = df.sparkSession, work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def uniform52(*parts: Column | str) -> Column:
    """A whole number in [0, 2^52) drawn from the MD5 of the parts joined by ``|`` (DuckDB can repeat it)."""
    joined = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("long")


def id_key(c: Column) -> Column:
    """Text of a key that tells a null from every value."""
    return F.coalesce(F.concat(F.lit("v"), c.cast("string")), F.lit("n"))


def expand_copies(df: DataFrame, copies: str, index: str, most: int, chunk: int = 4096) -> DataFrame:
    """One row for each of ``copies`` (index 0 up), which are ``most`` at most. Many copies of a row are dealt out in chunks to all tasks."""
    at, n = free_name(df, "chunk"), F.col(copies)
    if most <= chunk:
        return df.filter(n > 0).withColumn(index, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    parts = df.filter(n > 0).withColumn(at, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk)))).hint("rebalance")
    return parts.withColumn(index, F.explode(F.sequence(F.col(at) * chunk, F.least((F.col(at) + 1) * chunk, n) - 1))).drop(at)


def segments(data: bytes, size: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes, cut after ASCII white space; a longer run without any stays whole."""
    at, end = 0, len(data)
    if end <= size:
        yield data
        return
    while at < end:
        to = min(at + size, end)
        while to < end and data[to - 1] not in SPACES:
            step = data[to:to + 4096]
            cut = next((i for i, b in enumerate(step) if b in SPACES), None)
            to = min(to + (len(step) if cut is None else cut + 1), end)
        yield data[at:to]
        at = to


def small_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        new = new[label]
        if (new == label).all():
            return label
        label = new


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b) of longs: (node, component), the component's smallest node.

    Alternating large-star and small-star steps until nothing changes. Each step writes its links and its
    minima to the shared folder, so that a joined hot node has a plain exchange on both sides, which adaptive
    execution splits, and lost executors cost one step at most. Only counts and checksums reach the driver.
    """
    def step(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            near = edges
        low = written(near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "minima")
        met = near.join(low, "a")
        if large:
            out = met.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                low.select("a", F.col("m").alias("b")))
        return written(out.filter("a != b").distinct(), "edges")

    def mark(edges: DataFrame) -> tuple:
        return tuple(edges.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = written(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    seen = mark(edges)
    while seen[0]:
        edges = step(step(edges, True), False)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def slices(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow batches in slices of a few rows, so that a task holds few texts as Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def worker_state() -> dict:
    """What a Python worker keeps from one task to the next, as long as Spark uses it again (memories, opened models)."""
    import sys
    return sys.__dict__.setdefault("_llm_worker_state", {})

"""Embedding near-duplicates by PCA-ordered tiled comparison."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, small_components, written

THRESHOLD = 0.93
#: Vectors of a tile's side, and how many leading dimensions each step adds.
TILE, STEPS = 1024, (8, 16, 40)
#: Room for rounding in bounds; survivors are measured again exactly.
SLACK = 1e-9


def usable_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, v (array of doubles), label, ok: vectors that are null or zero or hold null or non-finite components and
    those without a label aren't ok."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = F.col(label_col).isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).alias("vec_id"), v.alias("v"), F.col(label_col).alias("label"), F.coalesce(ok, F.lit(False)).alias("ok"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of huge and tiny values finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows by a power of two, so that no square over- or underflows and no digit changes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def rotations(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vector, its principal axes as columns, in order of falling variance.

    From the sums of products over all unit vectors, which tasks add up: the driver gets one matrix for each length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            lengths = b.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                x = _unit(_matrix(b.column(0).filter(pa.array(lengths == d))))
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))], ["d", "i", "m"])

    def added(cells: DataFrame) -> DataFrame:
        return cells.select("d", "i", F.posexplode("m").alias("j", "x")).groupBy("d", "i", "j").agg(F.sum("x").alias("x"))

    out: dict[int, np.ndarray] = {}
    for d, i, j, x in added(classes.select("v").mapInArrow(run, "d int, i int, m array<double>")).collect():
        out.setdefault(d, np.zeros((d, d)))[i, j] = x
    return {d: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy() for d, m in out.items()}


def matches(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) whose cosine in double precision is at least ``threshold``; if same, only row a < row b.

    Products are summed over the leading principal axes first. What the other axes can add is at most the product of the
    norms there (Cauchy-Schwarz), so a pair is given up as soon as sum and bound stay below the threshold.
    """
    a, b = _scaled(a), _scaled(b)
    ra, rb = _unit(a) @ axes, _unit(b) @ axes
    na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    suffix = lambda r, p: np.sqrt(np.maximum(0, (r[:, p:] * r[:, p:]).sum(axis=1)))
    first = min(STEPS[0], a.shape[1])
    tail_b = suffix(rb, first)
    out_a, out_b = [], []
    for at in range(0, len(a), block):
        part = ra[at:at + block]
        sums = part[:, :first] @ rb[:, :first].T
        i, j = np.nonzero(sums + suffix(part, first)[:, None] * tail_b >= threshold - SLACK)
        sums = sums[i, j]
        i = i + at
        if same:
            i, j, sums = i[i < j], j[i < j], sums[i < j]
        done = first
        for more in STEPS[1:]:
            to = min(done + more, a.shape[1])
            if to == done or not len(i):
                break
            sa, sb = suffix(ra, to), suffix(rb, to)
            keep = np.zeros(len(i), bool)
            for k in range(0, len(i), 1 << 16):
                x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                sums[k:k + (1 << 16)] += np.einsum("nd,nd->n", ra[x, done:to], rb[y, done:to])
                keep[k:k + (1 << 16)] = sums[k:k + (1 << 16)] + sa[x] * sb[y] >= threshold - SLACK
            i, j, sums, done = i[keep], j[keep], sums[keep], to
        for k in range(0, len(i), 1 << 16):
            x, y = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
            ok = np.einsum("nd,nd->n", a[x], b[y]) / (na[x] * nb[y]) >= threshold
            out_a.append(x[ok])
            out_b.append(y[ok])
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (none, none)


def _tiles(classes: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """Rows (tile, side, rep, copies, v) of the tiles to compare: vectors of one label and length are cut into bands by the
    first principal coordinate; only vectors of one or neighbouring bands can be close enough. Bands are cut into chunks."""
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    leading = {d: m[:, 0].copy() for d, m in axes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(b.schema.get_field_index("v"))
            lengths = v.value_lengths().to_numpy(zero_copy_only=False)
            band = np.zeros(b.num_rows, np.int32)
            for d in np.unique(lengths):
                mine = lengths == d
                x = _unit(_matrix(v.filter(pa.array(mine)))) @ leading[int(d)]
                band[mine] = np.floor((x + 1) / width)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lengths.astype(np.int32)), pa.array(band)], [*b.schema.names, "d", "band"])

    kind = classes.schema["label"].dataType.simpleString()
    rep = classes.schema["rep"].dataType.simpleString()
    banded = written(classes.select("rep", "label", "copies", "v").mapInArrow(
        run, f"rep {rep}, label {kind}, copies bigint, v array<double>, d int, band int"), "bands")
    cells = banded.groupBy("label", "d", "band").count().select(
        "label", "d", "band", F.ceil(F.col("count") / TILE).cast("int").alias("chunks"))
    after = cells.select("label", "d", (F.col("band") - 1).alias("band"), F.col("chunks").alias("chunks_after"))
    before = cells.select("label", "d", (F.col("band") + 1).alias("band"), F.col("chunks").alias("chunks_before"))
    cells = written(cells.join(after, ["label", "d", "band"], "left").join(before, ["label", "d", "band"], "left"), "cells")
    row = banded.join(cells, ["label", "d", "band"]).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))

    def tile(band_a, chunk_a, band_b, chunk_b, side):  # noqa: ANN001, ANN202
        return F.struct(band_a.alias("ba"), chunk_a.alias("ca"), band_b.alias("bb"), chunk_b.alias("cb"), F.lit(side).alias("side"))

    own, band = F.col("own"), F.col("band")
    chunks = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    inside = F.transform(chunks(F.col("chunks")), lambda c: F.struct(
        band.alias("ba"), F.least(own, c).alias("ca"), band.alias("bb"), F.greatest(own, c).alias("cb"),
        F.when(own <= c, F.lit(0)).otherwise(F.lit(1)).alias("side")))
    up = F.transform(chunks(F.col("chunks_after")), lambda c: tile(band, own, band + 1, c, 0))
    down = F.transform(chunks(F.col("chunks_before")), lambda c: tile(band - 1, c, band, own, 1))
    return row.withColumn("t", F.explode(F.concat(inside, up, down))).select(
        F.xxhash64("label", "d", "t.ba", "t.ca", "t.bb", "t.cb").alias("deal"), "label", "d", "t.ba", "t.ca", "t.bb", "t.cb", "t.side", "rep", "copies", "v")


def _compared(tiles: DataFrame, axes: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """rep, other, n: a link of a spanning forest of each tile's matches (other), and n copies that match rep there."""
    names = ["label", "d", "ba", "ca", "bb", "cb"]

    def compared(key: tuple, batch: list[pa.Table]) -> pa.RecordBatch:
        t = pa.concat_tables(batch).combine_chunks()
        side, rep = t.column("side").to_numpy(), t.column("rep").to_numpy()
        copies, v = t.column("copies").to_numpy(), _matrix(t.column("v").combine_chunks() if isinstance(t.column("v"), pa.ChunkedArray) else t.column("v"))
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = key[2:4] == key[4:6]
        if same:
            x = y = np.arange(len(rep))
        if not len(x) or not len(y):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["rep", "other", "n"])
        i, j = matches(v[x], v[y], axes[key[1]], threshold, same)
        i, j = x[i], y[j]
        n = np.zeros(len(rep), np.int64)
        np.add.at(n, i, copies[j])
        np.add.at(n, j, copies[i])
        root = small_components(len(rep), i, j)
        out = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(rep[out]), pa.array(rep[root[out]]), pa.array(n[out])], ["rep", "other", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            t = pa.Table.from_batches([b])
            keys = list(zip(*[t.column(c).to_pylist() for c in names], strict=True))
            at = 0
            while at < len(keys):
                to = at + 1
                while to < len(keys) and keys[to] == keys[at]:
                    to += 1
                if keys[at] != now and held:
                    yield compared(now, held)
                    held = []
                now = keys[at]
                held.append(t.slice(at, to - at))
                at = to
        if held:
            yield compared(now, held)

    dealt = tiles.repartition("deal").sortWithinPartitions("deal", *names)
    return dealt.drop("deal").mapInArrow(run, "rep bigint, other bigint, n bigint")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row: vectors of equal, not null labels link at cosine >= threshold.

    n_links: other rows linked directly; component_id: the smallest vec_id reachable, itself included; kept: vec_id =
    component_id. A vector that is null, zero or holds null or non-finite components, or has no label, links with
    nothing, and so do vectors of different lengths. Equal vectors of a label are compared once, as one class of
    copies; equal ids are rows of their own, and a null id is never kept. An empty table gives an empty result; other columns
    aren't read. Ids must be whole numbers.
    """
    rows = written(usable_vectors(vectors, id_col, vector_col, label_col), "vectors")
    good = rows.filter("ok")
    # -0.0 and 0.0 are one value for grouping and joins
    classes = written(good.groupBy("label", "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn(
        "rep", F.monotonically_increasing_id()), "classes")
    axes = rotations(classes)
    found = written(_compared(_tiles(classes, axes, threshold), axes, threshold), "matches")
    n = found.groupBy("rep").agg(F.sum("n").alias("n"))
    member = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    known = classes.join(n, "rep", "left").join(member.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "v", "first", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "rep").alias("component"))
    known = written(known, "known")
    least = written(known.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    by_class = written(known.join(least, "component").select(
        "label", "v", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id"), "by-class")
    linked = good.join(by_class, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER () AS r FROM embeddings),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.r AS a, b.r AS b FROM g a JOIN g b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT r, r FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b)
SELECT v.vec_id, coalesce(n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) n ON n.a = v.r
JOIN (SELECT reach.a, min(w.vec_id) AS component_id FROM reach JOIN v w ON w.r = reach.b GROUP BY reach.a) c ON c.a = v.r
"""

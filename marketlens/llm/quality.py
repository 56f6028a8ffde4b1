"""Quality classifier: learned vectors of hashed words and character n-grams, averaged per document, with a softmax output."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, segments, slices, written
from .text import mixed_bits, span_hashes, word_spans

#: 2^BITS vectors of DIM numbers; most labelled rows that the model is fitted on; passes over them and first step.
BITS, DIM = 18, 16
MAX_FIT_ROWS = 4000
#: Bytes of packed features that the fit takes at most: rows in the order of their hash, so a few huge texts don't fill the driver.
MAX_FIT_BYTES = 64 << 20
EPOCHS, RATE, SEED = 8, 3.0, 7
THRESHOLD = 0.3
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.where(_SPACE, 32, np.arange(256)).astype(np.uint32)


def _bucket(h: np.ndarray, seed: int) -> np.ndarray:
    """Highest bits of a multiplicative hash."""
    with np.errstate(over="ignore"):
        return ((h ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every feature, ascending by kind: words, pairs of neighbours, and 3- and 4-byte grams within a word and
    its borders. A pair is hashed by the exclusive or of its words, so all pairs of a word with itself share one bucket.
    """
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])  # the white space before each text
    start, end = word_spans(data, ~_SPACE)
    word = span_hashes(data, start, end)
    of_word = np.searchsorted(begin, start, "right") - 1
    same = of_word[1:] == of_word[:-1]
    x, inner = _BYTE[data], ~_SPACE[data]
    of_byte = np.repeat(np.arange(len(texts)), np.diff(begin))
    three = (x[:-2] << 16 | x[1:-1] << 8 | x[2:])
    at3 = np.flatnonzero(inner[1:-1])
    at4 = np.flatnonzero(inner[1:-2] & inner[2:-1])
    grams3 = _bucket(three[at3].astype(np.uint64), 3)
    grams4 = _bucket(three[at4].astype(np.uint64) << np.uint64(8) | x[at4 + 3].astype(np.uint64), 1 << 40)
    return (np.concatenate([_bucket(word, 1), _bucket(mixed_bits(word[1:] ^ word[:-1])[same], 2), grams3, grams4]).astype(np.int64),
            np.concatenate([of_word, of_word[1:][same], of_byte[at3], of_byte[at4]]))


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Pieces of texts, of about a megabyte together, and the text that each belongs to; long texts are cut after white space."""
    out, owner, size = [], [], 0
    for i, t in enumerate(texts):
        for p in segments((t or "").encode("utf-8", "surrogatepass"), 1 << 19):
            if out and size + len(p) > 1 << 19:
                yield out, owner
                out, owner, size = [], [], 0
            out.append(p)
            owner.append(i)
            size += len(p)
    if out:
        yield out, owner


def fit_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             max_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """y, features (packed), n: the different ones of at most ``max_rows`` labelled rows outside the held-out fifth, n of each.

    Ids are taken in the order of a hash, so the sample doesn't depend on how the tables are laid out. Labels other than 0 and 1
    and null ids are left out; of several labels of an id the largest counts. Each id gives one row, and as long as rows are
    missing the others of these ids follow in the order of a hash of id and text, so an id that repeats often doesn't crowd others out.
    """
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(
        F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    known = known.join(docs.select(F.col(id_col).alias("id")).distinct(), "id", "left_semi")
    known = known.orderBy(F.md5(F.col("id").cast("string")), "id").limit(max_rows)
    known = written(known, "fit-ids")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit("n")).alias("hash"))
    # copies of a row are one row with a count, so at most max_rows of them are ever needed
    folded = rows.select("id", "hash").join(F.broadcast(known), "id").groupBy("id", "hash").agg(F.max("y").alias("y"), F.count("*").alias("n"))
    folded = written(folded, "fit-folded")
    first = folded.groupBy("id").agg(F.min("hash").alias("hash")).withColumn("first", F.lit(1))
    # an id's first row goes ahead of all, and its further copies behind with the other rows
    ranked = folded.join(F.broadcast(first), ["id", "hash"], "left").select(
        "id", "hash", "y", F.explode(F.when(F.col("first") == 1, F.array(
            F.struct(F.lit(0).alias("late"), F.lit(1).cast("long").alias("n")), F.struct(F.lit(1).alias("late"), (F.col("n") - 1).alias("n")))).otherwise(
            F.array(F.struct(F.lit(1).alias("late"), F.col("n").alias("n"))))).alias("x")).select("id", "hash", "y", "x.late", "x.n").filter("n > 0")
    order = ["late", F.md5(F.concat_ws("|", F.col("id").cast("string"), "hash")), "id", "hash"]
    top = ranked.orderBy(*order).limit(max_rows)
    ahead = F.coalesce(F.sum("n").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = top.withColumn("n", F.least("n", max_rows - ahead)).filter("n > 0").groupBy("id", "hash", "y").agg(F.sum("n").alias("n"))
    texts = rows.join(F.broadcast(written(top, "fit-rows")), ["id", "hash"]).groupBy("id", "hash").agg(
        F.first("y").alias("y"), F.first("n").alias("n"), F.first("text").alias("text")).select("y", "text", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            found: list[list[np.ndarray]] = [[] for _ in range(b.num_rows)]
            for part, owner in _pieces(b.column(1).to_pylist()):
                bucket, piece = features(part)
                owner = np.array(owner)[piece]
                for i in np.unique(owner):
                    found[i].append(bucket[owner == i])
            pairs = [np.unique(np.concatenate(x) if x else np.zeros(0, np.int64), return_counts=True) for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([packed(*p) for p in pairs], pa.binary()), b.column(2)], ["y", "features", "n"])

    return texts.mapInArrow(run, "y int, features binary, n bigint")


def packed(buckets: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending buckets and their counts in a byte or two each."""
    return zlib.compress(np.concatenate([np.diff(buckets, prepend=0), counts]).astype("<u4").tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The buckets, and the share of each in the text."""
    flat = np.frombuffer(zlib.decompress(data), "<u4")
    count = flat[len(flat) // 2:]
    return np.cumsum(flat[:len(flat) // 2], dtype=np.int64), (count / max(1, int(count.sum()))).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    """Whether an id belongs to the held-out fifth: crc32 of it as text, modulo 5, is 0. A null id doesn't."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


class Model:
    """Averaged vectors and softmax output, both learned by stochastic gradient descent."""

    def __init__(self, seed: int = SEED) -> None:
        self.rng = np.random.default_rng(seed)
        self.vectors = self.rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
        self.output = np.zeros((2, DIM), np.float32)
        self.bias = np.zeros(2, np.float32)

    def fit(self, rows: list[tuple[int, bytes]], epochs: int = EPOCHS, rate: float = RATE) -> Model:
        """rows: (label, packed features). One row at a time, in a new order each epoch, with a step that falls to zero."""
        if not rows:
            return self
        share = np.clip(np.mean([y for y, _ in rows]), 0.01, 0.99)
        self.bias[:] = np.log([1 - share, share])
        done, total = 0, epochs * len(rows)
        for _ in range(epochs):
            for i in self.rng.permutation(len(rows)):
                y, (bucket, part) = rows[i][0], unpacked(rows[i][1])
                step = np.float32(rate * (1 - done / total))
                done += 1
                some = self.vectors[bucket]
                hidden = part @ some
                z = self.output @ hidden + self.bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y] -= 1
                back = p @ self.output
                self.output -= step * np.outer(p, hidden)
                self.bias -= step * np.float32(0.1) * p
                if len(bucket):
                    # an average spreads the step over the features, so it is scaled up by how spread the text's shares are
                    self.vectors[bucket] = some - (step / (part @ part) ** 0.5) * np.outer(part, back)
        return self

    def weights(self) -> tuple[np.ndarray, float]:
        """Of each bucket what it adds to the difference of the two outputs, and their difference without any: the averaged
        vectors enter the softmax linearly, so these say all that a score needs."""
        return (self.vectors @ (self.output[1] - self.output[0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_rows: int = MAX_FIT_ROWS) -> tuple[np.ndarray, float]:
    """The weights fitted on at most ``max_rows`` labelled rows (see ``fit_rows``) with ``MAX_FIT_BYTES`` of features; all zero without any."""
    found = written(fit_rows(docs, labels, id_col, text_col, label_col, max_rows).select("*", F.sha1("features").alias("hash")), "fit-features")
    sizes = sorted(found.groupBy("hash").agg(F.max(F.length("features"))).collect())  # a row per text, max_rows at most
    total = np.cumsum([n for _, n in sizes])
    kept = sizes[:max(1, int(np.searchsorted(total, MAX_FIT_BYTES, "right")))]
    if len(kept) < len(sizes):
        found = found.filter(F.col("hash") <= kept[-1][0])
    rows = []
    for b in found.select("y", "features", "n").toArrow().to_batches():
        for y, data, n in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            rows += [(y, data)] * n
    pa.default_memory_pool().release_unused()
    rows.sort()  # the fit goes by their order, which isn't the tables'
    return Model().fit(rows).weights()


def scored(docs: DataFrame, weights: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier), ``predicted`` (1 from ``threshold`` on) and ``held_out``.

    Only the text enters the score, and all of it; a null or empty text, or one of white space, has the score of the bias alone. Rows with equal
    ids are returned each; an empty table gives an empty result; new names get underscores where ``docs`` has them.
    """
    each, bias = weights
    raw = each.tobytes()
    names = [f.name for f in docs.schema]
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(raw, np.float32)
        for b in slices(batches):
            total, n = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            for part, owner in _pieces(b.column(place).to_pylist()):
                bucket, piece = features(part)
                owner = np.array(owner)[piece]
                total += np.bincount(owner, w[bucket], b.num_rows)
                n += np.bincount(owner, minlength=b.num_rows)
            score = 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + bias, -500, 500)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(score)], [*[f"c{i}" for i in range(len(names))], "score"])

    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    out = plain.mapInArrow(run, f"{fields}, score double")
    score, predicted, held = (free_name(docs, x) for x in ("score", "predicted", "held_out"))
    out = out.toDF(*names, score)
    return out.withColumn(predicted, (F.col(score) >= threshold).cast("int")).withColumn(held, held_out(F.col(id_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs.select("doc_id", "text"), fit(docs, labels)).select("doc_id", "held_out", "score", "predicted")

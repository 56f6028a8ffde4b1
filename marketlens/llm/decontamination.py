"""Benchmark decontamination by a prefix-filtered set join over word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, slices, written
from .text import gram_hashes, in_blocks, span_hashes, word_spans

WINDOW_WORDS, SHINGLE_WORDS = 10, 5
#: Bits of the filter that tells document shingles that no benchmark item has: 2 MB whatever the tables' size.
FILTER_BITS = 24
PIECE_HITS = 2048
NAMES = ["doc_id", "row", "part", "n_words", "hits"]
_WORD_BYTE = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _lower(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased; null has no bytes."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def _words(block: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: all bytes, the words' starts, ends and hashes, and each text's first word (and the end)."""
    data = np.frombuffer(b" ".join(block), np.uint8)
    start, end = word_spans(data, _WORD_BYTE)
    ends = np.cumsum([len(t) + 1 for t in block])
    first = np.concatenate([[0], np.searchsorted(start, ends)])
    return data, start, end, span_hashes(data, start, end), first


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW_WORDS,
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The windows of each item: item_id, window (words joined by a space), n (words), hashes of its shingles in order.

    A window is ``window`` words in a row; an item of fewer words but not none is one window. A window of fewer than
    ``shingle`` words has one shingle of its own length. Null texts have no words; equal windows of one item are one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"item_id": [], "window": [], "n": [], "hashes": []}
            for item, text in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                t = _lower(text)
                data, start, end, h, _ = _words([t])
                n = min(window, len(start))
                k = min(shingle, n)
                grams = gram_hashes(h, k) if n else h
                words = [t[s:e].decode("utf-8", "surrogatepass") for s, e in zip(start, end, strict=True)]
                for i in range(len(words) - n + 1 if n else 0):
                    out["item_id"].append(item.as_py())
                    out["window"].append(" ".join(words[i:i + n]))
                    out["n"].append(n)
                    out["hashes"].append(grams[i:i + n - k + 1].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item_id"], b.column(0).type), pa.array(out["window"], pa.string()), pa.array(out["n"], pa.int32()),
                 pa.array(out["hashes"], pa.list_(pa.int64()))], ["item_id", "window", "n", "hashes"])

    kind = items.schema[id_col].dataType.simpleString()
    return items.select(id_col, text_col).mapInArrow(run, f"item_id {kind}, window string, n int, hashes array<bigint>").dropDuplicates(["item_id", "window"])


def _filter(hashes: DataFrame) -> bytes:
    """A bit for each hash's lowest FILTER_BITS bits. Tasks send their own set bits' words, at most the filter's size."""
    words = hashes.select(F.shiftright(F.col("h").bitwiseAND((1 << FILTER_BITS) - 1), 6).alias("w"),
                          F.expr("shiftleft(1L, cast(h & 63 AS INT))").alias("bit"))
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for w, b in words.groupBy("w").agg(F.bit_or("bit")).collect():
        bits[w] = b
    return bits.tobytes()


def _flags(filter_: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(filter_, np.uint8), bitorder="little").view(bool)


def _lengths(windows: DataFrame) -> list[int]:
    """Shingle lengths that occur: at most as many as a shingle has words."""
    return sorted(r[0] for r in windows.select("k").distinct().collect())


def _frequencies(docs: DataFrame, text_col: str, lengths: list[int], flags: bytes) -> DataFrame:
    """h, n: how often each shingle that passes the filter occurs in all documents, counted in each batch first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mask = _flags(flags), np.uint64((1 << FILTER_BITS) - 1)
        for b in slices(batches):
            texts = [_lower(t) for t in b.column(0).to_pylist()]
            for i, j in in_blocks(texts):
                _, _, _, h, first = _words(texts[i:j])
                for k in lengths:
                    g = gram_hashes(h, k)
                    hit = np.flatnonzero(known[g & mask])
                    doc = np.searchsorted(first, hit, "right") - 1
                    g = g[hit[hit + k <= first[doc + 1]]] if len(hit) else g[:0]
                    if len(g):
                        v, n = np.unique(g, return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    return docs.select(text_col).mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def _found(docs: DataFrame, id_col: str, text_col: str, lengths: list[int], flags: bytes, window: int) -> DataFrame:
    """doc_id, row, part, n_words and hits: the shingles that pass the filter, with the words around them.

    Part 0 of a row has its n_words; hits come in further parts of ``PIECE_HITS`` at most, so that a text made of items is no single
    row. A hit has its hash, its position, and ``window - 1`` words before it and after it, so that a window can be
    verified without the text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mask = _flags(flags), np.uint64((1 << FILTER_BITS) - 1)
        hit_type = pa.list_(pa.struct([("h", pa.int64()), ("k", pa.int32()), ("at", pa.int64()), ("before", pa.int32()), ("words", pa.list_(pa.string()))]))
        for b in slices(batches):
            texts = [_lower(t) for t in b.column(2).to_pylist()]
            n_words = np.zeros(len(texts), np.int64)
            hits: dict[int, list] = {}
            held = 0

            def pieces() -> pa.RecordBatch:
                of = list(hits)
                out = pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(of, pa.int64())), b.column(1).take(pa.array(of, pa.int64())), pa.array([1] * len(of), pa.int32()),  # noqa: B023
                     pa.array([None] * len(of), pa.int64()), pa.array([hits[i] for i in of], hit_type)], NAMES)  # noqa: B023
                hits.clear()  # noqa: B023
                return out

            for i, j in in_blocks(texts):
                data, start, end, h, first = _words(texts[i:j])
                n_words[i:j] = np.diff(first)
                raw = data.tobytes()
                for k in lengths:
                    g = gram_hashes(h, k)
                    hit = np.flatnonzero(known[g & mask])
                    for p, d in zip(hit, np.searchsorted(first, hit, "right") - 1, strict=True):
                        if p + k <= first[d + 1]:
                            lo, hi = max(first[d], p - window + 1), min(first[d + 1], p + k + window - 1)
                            hits.setdefault(int(i + d), []).append({
                                "h": int(g[p:p + 1].view(np.int64)[0]), "k": k, "at": int(p - first[d]), "before": int(p - lo),
                                "words": [raw[s:e].decode("utf-8", "surrogatepass") for s, e in zip(start[lo:hi], end[lo:hi], strict=True)]})
                            held += 1
                            if held == PIECE_HITS:
                                yield pieces()
                                held = 0
            if hits:
                yield pieces()
            none = pa.array([[]] * len(texts), hit_type)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([0] * len(texts), pa.int32()), pa.array(n_words), none], NAMES)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.monotonically_increasing_id().alias(free_name(docs, "row")), text_col).mapInArrow(
        run, f"doc_id {kind}, row bigint, part int, n_words bigint, hits array<struct<h bigint, k int, at bigint, before int, words array<string>>>")


def occurrences(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                item_text_col: str = "text", window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, occurrences, windows): doc_id, row, n_words of each row of ``docs``; row, window, start, n of each occurrence
    of a window in it; window, item_id of the items that each window comes from.

    A window counts as a set of its shingles that a document must contain whole, so one shingle is a necessary prefix.
    Shingles are ordered by how often they occur in all documents, and each window's rarest is its prefix; documents'
    shingles that a fixed-size filter of the prefixes lets pass are joined with it. A match then has to leave room for
    the window before and after it (position and length bounds), and the words of the whole window are compared.
    """
    windows = written(item_windows(items, item_id_col, item_text_col, window, shingle).withColumn(
        "k", F.least(F.lit(shingle), F.col("n"))), "windows")
    lengths = _lengths(windows)
    shingles = windows.select("k", F.explode("hashes").alias("h")).distinct()
    counts = written(_frequencies(docs, text_col, lengths, _filter(shingles)), "shingle-counts")
    # texts that occur in many items come once
    texts = windows.groupBy("window", "n", "k").agg(F.first("hashes").alias("hashes"))
    rarest = texts.select("window", F.col("n").alias("len"), "k", F.posexplode("hashes").alias("offset", "h")).join(
        counts, "h").groupBy("window", "len", "k").agg(
        F.min(F.struct("n", "h", "offset")).alias("p"), F.count("*").alias("seen"))
    # a shingle that occurs nowhere rules its window out
    rarest = written(rarest.filter(F.col("seen") == F.col("len") - F.col("k") + 1).select(
        "window", "len", "k", "p.h", "p.offset"), "prefixes")
    found = written(_found(docs, id_col, text_col, lengths, _filter(rarest), window), "shingle-hits")
    hits = found.select("row", F.explode("hits").alias("x")).select("row", "x.h", "x.k", "x.at", "x.before", "x.words")
    start = F.col("at") - F.col("offset")
    # the words around a hit reach as far as the window, or to the text's end
    inside = (start >= 0) & (F.col("before") >= F.col("offset")) & (F.col("before") - F.col("offset") + F.col("len") <= F.size("words"))
    same = F.concat_ws(" ", F.slice("words", F.col("before") - F.col("offset") + 1, F.col("len"))) == F.col("window")
    met = hits.join(rarest, ["h", "k"]).filter(inside).filter(same).select("row", "window", start.alias("start"), F.col("len").alias("n"))
    return found.filter("part = 0").select("doc_id", "row", "n_words"), met, windows.select("window", "item_id")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``.

    n_hit: words inside any occurrence of a window; n_items: items with such windows; items_sha256: of their ids,
    sorted as strings and joined by commas. A null or empty text has no words and no hits. Rows with equal ids are
    kept apart; a null id is returned as null. Items with a null id count as the id ``null``. Without items nothing
    is hit; an empty table gives an empty result; other columns aren't read.
    """
    found, at, windows = occurrences(docs, items, id_col, text_col, item_id_col, item_text_col, window, shingle)
    at = written(at, "occurrences")
    spans = at.select("row", "start", (F.col("start") + F.col("n")).alias("end")).groupBy("row", "start").agg(F.max("end").alias("end"))
    upto = F.max("end").over(Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(upto, F.lit(0))))
    covered = spans.withColumn("new", new).groupBy("row").agg(F.sum("new").alias("n_hit"))
    # a window that occurs again in a document, or comes from many items, meets them once
    items_of = at.select("row", "window").distinct().join(windows, "window")
    listed = items_of.select("row", F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item")).distinct().groupBy("row").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    out = found.join(covered, "row", "left").join(listed, "row", "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", items_), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""
WITH item AS (SELECT item_id, {_RUNS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
gram AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
         FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, item_id, i, n FROM gram JOIN win USING (n, win)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN ids USING (r)
"""

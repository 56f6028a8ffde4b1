"""Spelling variants: words one edit apart, found by one-edit neighbourhoods over a reduced alphabet."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written
from .sharding import _crc_table
from .text import PRIME, powers

MIN_LENGTH, MIN_COUNT, FORM_FACTOR = 6, 5, 5
DELETE_EVERY = 199
#: Symbols that letters are hashed to. Fewer make neighbourhoods smaller and their words more alike.
SYMBOLS = 8
#: Words that a task counts before it passes them on.
MEMORY = 300_000
_INVERSE = np.uint64(pow(PRIME, -1, 1 << 64))
#: Letters of Latin-1 by byte, A-Z in lower case, everything else a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                delete_every: int | None = DELETE_EVERY) -> DataFrame:
    """word, n: how often each word of at least ``min_length`` code points occurs in all texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased. With ``delete_every``, h is the CRC-32 of
    ``<id>:<word>``; where that number divides h, the word loses its code point h modulo its length. A null text has no words,
    a null id loses nothing. Words are counted in each task first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()),
                                              pa.array(total.values(), pa.int64())], ["word", "n"])
            total.clear()
            return out

        for b in batches:
            for i, t in zip(b.column(0), b.column(1), strict=True):
                t, i = t.as_py(), i.as_py()
                if not t:
                    continue
                seed = None if i is None or not delete_every else zlib.crc32(f"{i}:".encode())
                for w, n in Counter(t.encode("latin-1", "replace").translate(_LETTERS).split()).items():
                    if len(w) < min_length:
                        continue
                    if seed is not None:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), seed)
                        if h % delete_every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                            if len(w) < min_length:
                                continue
                    total[w] += n
            if len(total) > MEMORY:
                yield flush()
        yield flush()

    return docs.select(id_col, text_col).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def reduced(words: list[str], symbols: int = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all words, one after the other, and each word's length."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (points * np.uint64(2654435761) >> np.uint64(17)) % np.uint64(symbols), np.array([len(w) for w in words], np.int64)


class _Sums:
    """Polynomial sums of the symbols of some words, from which the key of any edited word follows in one step."""

    def __init__(self, symbols: np.ndarray, length: np.ndarray) -> None:
        self.symbol, self.length = symbols + np.uint64(1), length
        self.end = np.cumsum(length)
        self.word = np.repeat(np.arange(len(length)), length)
        self.place = np.arange(len(symbols)) - np.repeat(self.end - length, length)
        self.power = powers(PRIME, int(length.max(initial=0)) + 2)
        with np.errstate(over="ignore"):
            term = self.symbol * self.power[self.place]
            upto = np.append(np.uint64(0), np.cumsum(term))
            begin = upto[self.end - length]
            self.key = upto[self.end] - begin
            self.before = upto[:-1] - begin[self.word]
            self.after = self.key[self.word] - self.before - term

    def neighbours(self, symbols: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, key) of each word itself and all its different one-symbol replacements, deletions and insertions."""
        s, p, w = self.symbol, self.power[self.place], self.word
        words, keys = [np.arange(len(self.length))], [self.key]
        with np.errstate(over="ignore"):
            again = (self.place > 0) & (s == np.append(np.uint64(0), s[:-1]))  # deleting either of two equal symbols is the same
            words.append(w[~again])
            keys.append((self.before + self.after * _INVERSE)[~again])
            for x in range(1, symbols + 1):
                x = np.uint64(x)
                other = s != x  # an equal symbol replaces nothing, and put before its like it is the same as after it
                words += [w[other], w[other], words[0]]
                keys += [(self.before + x * p + self.after)[other],
                         (self.before + x * p + (s * p + self.after) * np.uint64(PRIME))[other],
                         self.key + x * self.power[self.length]]
        return np.concatenate(words), np.concatenate(keys)


def reduced_vocabulary(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """word, n with ``reduced`` (its symbols as text) and the key r of that."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, length = reduced(b.column(0).to_pylist(), symbols)
            sums, end = _Sums(code, length), np.cumsum(length)
            text = (code + np.uint64(65)).astype(np.uint8).tobytes().decode("ascii")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([text[e - n:e] for e, n in zip(end.tolist(), length.tolist(), strict=True)], pa.string()),
                 pa.array(sums.key.view(np.int64))], ["word", "n", "reduced", "r"])

    return words.select("word", "n").mapInArrow(run, "word string, n bigint, reduced string, r bigint")


def neighbourhoods(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(r, near): of each distinct reduced word the keys of its full one-edit neighbourhood, itself included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                texts = b.column(0).slice(at, 2048).to_pylist()
                code = np.frombuffer("".join(texts).encode("ascii"), np.uint8).astype(np.uint64) - np.uint64(65)
                sums = _Sums(code, np.array([len(t) for t in texts], np.int64))
                word, near = sums.neighbours(symbols)
                yield pa.RecordBatch.from_arrays([pa.array(sums.key[word].view(np.int64)), pa.array(near.view(np.int64))], ["r", "near"])

    return vocabulary.select("reduced").distinct().mapInArrow(run, "r bigint, near bigint")


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n) of all ordered pairs of ``words`` (word, n) that differ by one inserted, deleted or replaced code point.

    An edit of a word is an edit of its reduced word or leaves that as it is, so the neighbourhood of every word's
    reduced word holds the reduced words of all its near words; joined with the reduced vocabulary, few of its keys stay. The words
    behind each pair of reduced words are compared by edit distance. No pair is lost, however many words a reduced word stands for.
    """
    vocabulary = written(reduced_vocabulary(words, symbols), "vocabulary")
    there = vocabulary.select(F.col("r").alias("near")).distinct()
    both = written(neighbourhoods(vocabulary, symbols).join(there, "near").distinct(), "reduced-pairs")
    x = vocabulary.select("r", "word", "n")
    y = vocabulary.select(F.col("r").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    met = both.join(x, "r").join(y, "near").filter(F.levenshtein("word", "near_word", 1) == 1)
    return met.select("word", "n", F.col("near_word").alias("near"), "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): where following forms ends. Each round doubles the steps.

    A form occurs several times as often as its word, so the number of rounds grows with the logarithm of that of the count.
    """
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at_ = written(at.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                          F.col("further").isNotNull().alias("moved")), "roots")
        at = at_.select("word", "root")
        if at_.filter("moved").isEmpty():
            return at


def variant_groups(words: DataFrame, factor: int = FORM_FACTOR, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n), words being distinct.

    form: of the words one edit apart the one with the largest n, the smallest of several, if that n is at least ``factor``
    times the word's own; root: where forms lead, the word itself without one. An empty table gives an empty result.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = near_words(words, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.n")
    out = words.select("word", "n").join(near, "word", "left").withColumn("ok", form_n >= F.col("n") * factor)
    out = written(out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("ok"), F.col("best.word")).alias("form"),
                             F.when(F.col("ok"), form_n).alias("form_n")), "forms")
    ends = roots(out.filter("form IS NOT NULL"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, factor: int = FORM_FACTOR, delete_every: int | None = DELETE_EVERY,
                      symbols: int = SYMBOLS) -> DataFrame:
    """:func:`variant_groups` of the words that occur at least ``min_count`` times in ``docs`` (:func:`word_counts`)."""
    words = word_counts(docs, id_col, text_col, min_length, delete_every).filter(F.col("n") >= min_count)
    return variant_groups(written(words, "words"), factor, symbols)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = f"""
WITH RECURSIVE g AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= {MIN_LENGTH} GROUP BY doc_id, w),
h AS (
  SELECT w, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR) || ':' || w)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
                               lambda a, x: xor(a >> 8, crc[CAST((xor(a, x) & 255) + 1 AS INTEGER)]), 4294967295), 4294967295) AS h
  FROM g, (SELECT {_crc_table()} AS crc)),
v AS (
  SELECT w, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % {DELETE_EVERY} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS w, n FROM h)
  WHERE length(w) >= {MIN_LENGTH} GROUP BY w HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS x FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v)),
less AS (SELECT DISTINCT c.w AS a, v.w AS b, v.n, c.n AS m FROM cut c JOIN v ON c.x = v.w),
near AS (
  SELECT a.w AS a, b.w AS b, b.n FROM cut a JOIN cut b ON a.x = b.x AND a.i = b.i AND a.w <> b.w
  UNION ALL SELECT a, b, n FROM less UNION ALL SELECT b, a, m FROM less),
best AS (SELECT a, count(*) AS n_near, arg_min(b, (-n, b)) AS b, max(n) AS bn FROM near GROUP BY a),
f AS (SELECT v.w, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= {FORM_FACTOR} * v.n THEN b END AS form,
             CASE WHEN bn >= {FORM_FACTOR} * v.n THEN bn END AS form_n FROM v LEFT JOIN best ON a = v.w),
walk AS (SELECT w, w AS reached, form AS nxt FROM f UNION ALL SELECT walk.w, walk.nxt, f.form FROM walk JOIN f ON f.w = walk.nxt WHERE walk.nxt IS NOT NULL)
SELECT f.w AS word, form, reached AS root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM f JOIN walk ON walk.w = f.w AND walk.nxt IS NULL
"""

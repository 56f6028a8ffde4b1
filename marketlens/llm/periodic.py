"""Periodic runs of words, by a branching-tandem test on an enhanced suffix array."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices

MIN_LENGTH = 12
#: Words that are searched together, in numpy arrays of about this length; a longer text is searched alone.
BLOCK_WORDS = 1 << 18
#: Symbols of two neighbouring suffixes that are compared for all pairs at once before the rest goes pair by pair.
_TOGETHER = 16


def suffix_array(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sa, isa) of whole numbers of which the last occurs once, by prefix doubling of the suffixes still tied."""
    n = len(code)
    order = np.argsort(code)
    isa = np.empty(n, np.int64)

    def firsts(new: np.ndarray) -> np.ndarray:
        return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))

    def tied(new: np.ndarray) -> np.ndarray:
        return ~(new & np.append(new[1:], True))

    new = np.append(True, np.diff(code[order]) != 0)
    isa[order] = firsts(new)
    left, h = order[tied(new)], 1
    while len(left):
        high, low = isa[left], isa[left + h]
        key = high * n + low
        o = np.argsort(key)
        left, key, high = left[o], key[o], high[o]
        new = np.append(True, np.diff(key) != 0)
        isa[left] = high + firsts(new) - firsts(np.append(True, np.diff(high) != 0))
        left, h = left[tied(new)], 2 * h
    sa = np.empty(n, np.int64)
    sa[isa] = np.arange(n)
    return sa, isa


def common_prefixes(code: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """lcp[k], the symbols that suffixes k - 1 and k in order share; 0 at both ends (length n + 1).

    The first symbols of all pairs are compared together. Pairs that agree longer are taken in text order, where a
    pair shares at least one symbol fewer than the pair before it (Kasai).
    """
    lcp = np.zeros(len(sa) + 1, np.int64)
    at = np.flatnonzero(code[sa[1:]] == code[sa[:-1]]) + 1
    t = 1
    while len(at) and t < _TOGETHER:
        lcp[at] = t
        at = at[code[sa[at - 1] + t] == code[sa[at] + t]]
        t += 1
    if len(at):
        at = at[np.argsort(sa[at])]
        symbols, shared, last, out = code.tolist(), 0, -2, []
        for a, b in zip(sa[at - 1].tolist(), sa[at].tolist(), strict=True):
            shared = max(t, shared - 1) if b == last + 1 else t
            while symbols[a + shared] == symbols[b + shared]:
                shared += 1
            last = b
            out.append(shared)
        lcp[at] = out
    return lcp


def _nearest_smaller(lcp: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """For each of ``at`` the next place to the left or right (step -1, 1) with a smaller lcp, by pointer jumping."""
    to = np.arange(len(lcp)) + step
    open_ = at
    while len(open_):
        open_ = open_[lcp[to[open_]] >= lcp[open_]]
        to[open_] = to[to[open_]]
    return to[at]


def branching_tandems(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of every square that can't be moved one symbol to the right.

    For each LCP interval of depth d, the suffixes i of all its children but the largest are looked at: a square of
    period d starts at i or i - d where the suffix d further or back is in the same interval and the next symbols
    differ. Of two suffixes of different children one is in a smaller child, so no square is missed, and a suffix is
    looked at as often as its part doubles, O(n log n) in all.
    """
    sa, isa = suffix_array(code)
    lcp = common_prefixes(code, sa)
    k = np.flatnonzero(lcp)
    none = np.zeros(0, np.int64)
    if not len(k):
        return none, none
    depth, left, right = lcp[k], _nearest_smaller(lcp, k, -1), _nearest_smaller(lcp, k, 1)
    o = np.lexsort((k, depth, left))
    k, depth, left, right = k[o], depth[o], left[o], right[o]
    new = np.append(True, (np.diff(left) != 0) | (np.diff(depth) != 0))
    first, group = np.flatnonzero(new), np.cumsum(new) - 1
    # children: one before each k of the interval, and the last one after its last k
    start = np.where(new, left, np.append(0, k[:-1]))
    size, last = k - start, np.append(first[1:], len(k)) - 1
    tail = right[last] - k[last]
    most = np.maximum(np.maximum.reduceat(size, first), tail)
    keep = np.ones(len(k), bool)
    largest = np.flatnonzero((size == most[group]) & (tail != most)[group])
    keep[largest[np.append(True, np.diff(group[largest]) != 0)] if len(largest) else largest] = False
    keep_tail = tail != most
    child = np.concatenate([start[keep], k[last][keep_tail]])
    count = np.concatenate([size[keep], tail[keep_tail]])
    of = np.concatenate([group[keep], np.flatnonzero(keep_tail)])
    ends, periods = [none], [none]
    upto, total = np.cumsum(count), 0
    while total < len(child):  # a few suffixes at a time
        base = upto[total - 1] if total else 0
        to = max(total + 1, int(np.searchsorted(upto, base + 4 * BLOCK_WORDS, "right")))
        c = count[total:to]
        place = np.arange(c.sum()) + np.repeat(child[total:to] - (upto[total:to] - c - base), c)
        g = first[np.repeat(of[total:to], c)]
        i, d, lo, hi = sa[place], depth[g], left[g], right[g]
        for j, square in ((i + d, i), (i - d, i - d)):
            ok = (j >= 0) & (j < len(code))
            there = isa[np.where(ok, j, 0)]
            ok = np.flatnonzero(ok & (there >= lo) & (there < hi))
            s, p = square[ok], d[ok]
            branch = code[s + p] != code[s + 2 * p]
            ends.append((s + 2 * p)[branch])
            periods.append(p[branch])
        total = to
    both = np.unique(np.concatenate(ends) * (len(code) + 1) + np.concatenate(periods))
    return both // (len(code) + 1), both % (len(code) + 1)


def find_runs(code: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs: smallest period, at least two periods and ``min_length`` symbols, not extendable.

    ``code`` begins and ends with symbols that occur once. Each run ends with one branching square of its period; it
    is rotated to the left as far as the symbols a period apart agree. A square whose period is a multiple of that of
    a run over it belongs to that run.
    """
    end, period = branching_tandems(code)
    ok = np.ones(len(end), bool)
    for t in range(1, max(0, min_length - 1)):  # short periods need more than a square
        s = np.maximum(end - 2 * period - t, 0)
        ok &= (2 * period + t > min_length) | (code[s] == code[s + period])
    out: list[tuple[int, int, int]] = []
    here: list[tuple[int, int]] = []
    at = -1
    for e, p in zip(end[ok].tolist(), period[ok].tolist(), strict=True):
        if e != at:
            here, at = [], e
        if any(p % q == 0 and s <= e - 2 * p for s, q in here):
            continue
        s, step = e - 2 * p, 32
        while True:
            step = min(step, s)
            differ = np.flatnonzero(code[s - step:s] != code[s - step + p:s + p])
            if len(differ):
                s -= step - 1 - int(differ[-1])
                break
            s, step = s - step, 2 * step
        here.append((s, p))
        out.append((s, e, p))
    return out


def _coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of some texts, different from text to text, with a symbol of its own around each; and where each begins."""
    n = sum(map(len, texts)) + len(texts) + 1
    code, first, at = np.empty(n, np.int64), np.empty(len(texts) + 1, np.int64), 1
    code[0] = 0
    for i, words in enumerate(texts):
        first[i] = at
        numbers = dict(zip(words, range(at, at + len(words)), strict=True))
        code[at:at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        at += len(words)
        code[at] = at
        at += 1
    first[-1] = at
    return code, first


Rewrite = Callable[[object, list[bytes]], list[bytes]]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed for every row of ``docs``.

    Words are runs of bytes other than ASCII white space, numbered from 0 in the whole text. ``collapsed`` holds the words
    that aren't in any run after that run's first period, joined by one space. ``rewrite(id, words)`` gives the words to
    search in place of the text's own. A null or empty text has no words and no runs; rows with equal or null ids are
    returned each; an empty table gives an empty result; other columns aren't read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for b in slices(batches):
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in b.column(1).to_pylist()]
            if rewrite:
                texts = [rewrite(i, w) for i, w in zip(b.column(0).to_pylist(), texts, strict=True)]
            runs: list[list[dict]] = [[] for _ in texts]
            at = 0
            while at < len(texts):
                to, total = at, 0
                while to < len(texts) and (to == at or total + len(texts[to]) <= BLOCK_WORDS):
                    total += len(texts[to])
                    to += 1
                code, first = _coded(texts[at:to])
                for s, e, p in find_runs(code, min_length):
                    i = int(np.searchsorted(first, s, "right")) - 1
                    runs[at + i].append({"start": s - int(first[i]), "length": e - s, "period": p})
                at = to
            collapsed = []
            for words, found in zip(texts, runs, strict=True):
                if found:
                    found.sort(key=lambda r: (r["start"], r["period"]))
                    edge = np.zeros(len(words) + 1, np.int64)
                    for r in found:
                        edge[r["start"] + r["period"]] += 1
                        edge[r["start"] + r["length"]] -= 1
                    words = [words[j] for j in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                collapsed.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {id_type}, n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, collapsed string")


def repeated_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words that the query searches: for a tenth of the ids, by CRC-32 of the decimal id, a part of the text repeats to its
    end. A null id keeps its words."""
    if doc_id is None or not words:
        return words
    g, tenth = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if tenth:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run's start, length, period and exponent_milli, runs_sha256, collapsed_sha256 of :func:`periodic_runs`."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    out = found.withColumn("longest", longest)
    length, period = F.col("longest.length"), -F.col("longest.period")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), length.alias("length"),
                      period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
                      F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), rewrite=repeated_tail))

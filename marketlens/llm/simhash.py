"""SimHash near-duplicates found by Golay-code fuzzy hashing of fingerprint segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, segments, slices, small_components, written

SHINGLE_WORDS, MAX_BITS = 4, 4
#: The three segments of a fingerprint; each is a shortened word of the 23-bit Golay code.
WIDTHS = (22, 21, 21)
#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
#: Fingerprints with one key that a task compares at a time.
TILE = 2048


def _byte_bits() -> np.ndarray:
    return ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text: a bit is 1 if it is set in over half of the shingles' XXH64 (seed 42).

    A-Z are lower-cased; words are runs without ASCII white space; a shingle is ``shingle`` words joined by a space,
    repeats included, or the whole sequence if it is shorter. No words (or a null text): 0. Works through the text in
    segments, so memory is bounded for any length.
    """
    counts, total, carry = np.zeros(64, np.int64), 0, []
    hash64, bits = xxhash.xxh64_intdigest, _byte_bits()

    def add(hashes: list[int]) -> int:
        each = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
        if len(each) < 512:
            counts[:] += np.unpackbits(each, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            for i in range(8):
                counts[8 * i:8 * i + 8] += np.bincount(each[:, i], minlength=256) @ bits
        return len(each)

    for part in segments((text or "").encode("utf-8", "surrogatepass").lower()):
        words = carry + part.split()
        if len(words) >= shingle:
            line = b" ".join(words)
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            ends = np.cumsum(lengths) - 1
            starts = ends - lengths + 1
            total += add([hash64(line[s:e], 42) for s, e in zip(
                starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)])
        carry = words[max(0, len(words) - shingle + 1):] if shingle > 1 else []
    if not total and carry:
        total += add([hash64(b" ".join(carry), 42)])
    return int((2 * counts > total) @ (np.uint64(1) << np.arange(64, dtype=np.uint64))) if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp bigint")


class Golay:
    """Decoder of the perfect (23, 12) Golay code: each 23-bit word is within 3 bits of one codeword."""

    def __init__(self) -> None:
        def remainder(w: int) -> int:
            for i in range(22, 10, -1):
                if w >> i & 1:
                    w ^= GENERATOR << (i - 11)
            return w

        each = [remainder(1 << i) for i in range(23)]
        self.error = np.zeros(2048, np.int64)  # by syndrome: the error pattern of at most three bits
        for i in range(23):
            self.error[each[i]] = 1 << i
            for j in range(i):
                self.error[each[i] ^ each[j]] = 1 << i | 1 << j
                for k in range(j):
                    self.error[each[i] ^ each[j] ^ each[k]] = 1 << i | 1 << j | 1 << k
        self.syndrome = np.zeros((3, 256), np.int64)  # by byte
        for part in range(3):
            for bit in range(8):
                if 8 * part + bit < 23:
                    self.syndrome[part] ^= np.where(np.arange(256) >> bit & 1, each[8 * part + bit], 0)

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12-bit index (message) of the codeword nearest to each word."""
        s = self.syndrome[0][words & 255] ^ self.syndrome[1][words >> 8 & 255] ^ self.syndrome[2][words >> 16]
        return (words ^ self.error[s]) >> 11


def golay_keys(fps: np.ndarray, code: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(position in fps, key) of all keys of the fingerprints.

    Two fingerprints at 4 bits or fewer differ in 2 or fewer over some pair of the three segments (two thirds of 4,
    rounded down). Somewhere between them lies a word that differs from each in at most one bit of that pair. So the
    keys of a fingerprint are, for each pair, the codeword indices of the pair as it is and with any one bit flipped:
    (decoded neighbours of the one, decoded other) and the reverse. Most flips decode alike, which leaves about ten
    keys a pair.
    """
    parts, shift = [], 0
    for width in WIDTHS:
        parts.append((fps >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1))
        shift += width
    own = [code.index(p) for p in parts]
    near = []
    for p, width, mine in zip(parts, WIDTHS, own, strict=True):
        ball = np.sort(np.stack([mine, *(code.index(p ^ (1 << i)) for i in range(width))], axis=1), axis=1)
        new = np.ones(ball.shape, bool)
        new[:, 1:] = ball[:, 1:] != ball[:, :-1]
        near.append((ball, new))
    at, keys = [], []
    for n, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        row, col = np.nonzero(near[i][1])
        at.append(row)
        keys.append(n << 24 | near[i][0][row, col] << 12 | own[j][row])
        row, col = np.nonzero(near[j][1] & (near[j][0] != own[j][:, None]))
        at.append(row)
        keys.append(n << 24 | own[i][row] << 12 | near[j][0][row, col])
    return np.concatenate(at), np.concatenate(keys)


def _keyed(prints: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            at, keys = golay_keys(fps.view(np.uint64), code)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(fps[at])], ["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key int, fp bigint")


def _close(fps: np.ndarray, bits: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions at ``bits`` bits or fewer."""
    a, b = [], []
    for i in range(0, len(fps), block):
        x, y = np.nonzero(np.bitwise_count(fps[i:i + block, None] ^ fps[None, i:]) <= bits)
        ok = x < y
        a.append(x[ok] + i)
        b.append(y[ok] + i)
    return np.concatenate(a), np.concatenate(b)


def _forest(key: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fp, fp) that connect what is close within each run of equal keys: one for each member but the first."""
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.concatenate([start, [len(key)]]))
    out_a, out_b = [], []
    # small runs all at once: each row with the one s further on
    small = np.repeat(size <= 32, size)
    left = np.repeat(start + size, size)
    for s in range(1, 32):
        i = np.flatnonzero(small & (np.arange(len(key)) + s < left))
        if not len(i):
            break
        i = i[np.bitwise_count(fps[i] ^ fps[i + s]) <= bits]
        out_a.append(fps[i + s])
        out_b.append(fps[i])
    for at, n in zip(start[size > 32], size[size > 32], strict=True):
        own = fps[at:at + n]
        root = small_components(n, *_close(own, bits))
        i = np.flatnonzero(root != np.arange(n))
        out_a.append(own[i])
        out_b.append(own[root[i]])
    if not out_a:
        return fps[:0], fps[:0]
    return np.concatenate(out_a), np.concatenate(out_b)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all that differ in ``max_bits`` or fewer.

    Fingerprints meet under their Golay keys and are verified by their bit distance. A key with many of them is cut into
    chunks by a hash, and each pair of chunks is compared by a task of its own. A task passes on a spanning forest of
    what it has found, not all pairs, which leaves the components as they are.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the Golay keys find 0 to {MAX_BITS} differing bits")
    keyed = written(_keyed(prints), "golay-keys")
    large = written(keyed.groupBy("key").count().filter(F.col("count") > TILE).select(
        "key", F.ceil(F.col("count") / TILE).cast("int").alias("chunks")), "golay-large")
    chunks, own = F.coalesce("chunks", F.lit(1)), F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int")
    others = F.filter(F.sequence(F.lit(0), chunks - 1), lambda i: (i != F.col("own")) | (chunks == 1))
    tiles = keyed.join(large, "key", "left").withColumn("own", own).withColumn("other", F.explode(others)).select(
        "key", (F.least("own", "other").cast("long") * 1_000_000 + F.greatest("own", "other")).alias("tile"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def found(block: np.ndarray) -> pa.RecordBatch:
            group = np.concatenate([[0], np.cumsum((block[1:, 0] != block[:-1, 0]) | (block[1:, 1] != block[:-1, 1]))])
            a, b = _forest(group, np.ascontiguousarray(block[:, 2]).view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            new = np.stack([batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64),
                            batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)], axis=1)
            if not len(new):
                continue
            change = np.flatnonzero((new[1:, 0] != new[:-1, 0]) | (new[1:, 1] != new[:-1, 1]))
            same = bool(held) and (held[-1][-1, :2] == new[0, :2]).all()
            if held and not same:
                yield found(np.concatenate(held))
                held = []
            if len(change):
                cut = change[-1] + 1
                yield found(np.concatenate([*held, new[:cut]]))
                held = [new[cut:]]
            else:
                held.append(new)
        if held:
            yield found(np.concatenate(held))

    return tiles.repartition("key", "tile").sortWithinPartitions("key", "tile").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links) of every row.

    Rows link when their fingerprints differ in ``max_bits`` bits or fewer; equal texts, and all texts without words
    (null too), have equal fingerprints and so one component. Rows with a null id take part in links; a component in
    which all ids are null has a null component_id. Ids may be of any type that can be ordered. Rows with equal ids are returned
    each; an empty table gives an empty result; other columns aren't read.
    """
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    member = components(links(distinct, max_bits))
    joined = distinct.join(member.select(F.col("node").alias("fp"), "component"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = written(joined.groupBy("component").agg(F.min("first").alias("component_id")), "least")
    by_print = written(joined.join(least, "component").select("fp", "component_id"), "by-print")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Token ids of documents in files of canonical length-limited Huffman codes.

File: ``HUF1``, an 8-byte little-endian length of the head, the head (zlib of JSON: ids' code lengths as [id, length] pairs in
runs, block size), the code bits, the index (zlib of Arrow IPC: for each document its id, first byte, number of ids, and the bit of
each block relative to that byte), the index's length and place (two 8-byte numbers) and ``HUF1``.
"""

from __future__ import annotations

import bisect
import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, slices, work_folder, worker_state, written
from .files import Output, open_input
from .huffman import BLOCK, Decoder, Encoder, code_lengths

END_ID = 2
#: Ids of a file, and of what a task holds at a time.
FILE_IDS, CHUNK_IDS = 8_000_000, 1 << 17
#: Most files: beyond so many, files grow with the table, and the list of their borders that tasks get doesn't.
MAX_FILES = 1 << 15
MAGIC = b"HUF1"
#: Pieces that a worker remembers, and bytes of them and their ids; bytes of text that it cuts at a time.
MEMORY, MEMORY_BYTES, SLICE_BYTES = 1_000_000, 1 << 27, 1 << 23
#: Where a long text may be cut: before a single space between two characters that aren't white space.
_SAFE = re.compile(r"(?<=\S)(?= \S)")


def _marked(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags, set in the ranges (with their ends)."""
    out = np.zeros(256, bool)
    for a, z in ranges:
        out[a:z + 1] = True
    return out


# Tables over UTF-8 bytes. _SOLID: first bytes of characters that are no white space for certain; _BEHIND: ASCII that is no letter, white
# space or control; _LATIN2: second bytes of the Latin letters that begin with 0xC3.
_ASCII_LETTER = _marked((65, 90), (97, 122))
_SOLID = _marked((33, 126), (0xC3, 0xE0), (0xE4, 0xF4))
_BEHIND = _marked((33, 126)) & ~_ASCII_LETTER
_LATIN2 = _marked((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))
_KIND = _BEHIND * np.uint8(2)
_KIND[[10, 32]] = 1
_WORD = r"\A ?[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+\z"
#: White space elsewhere than as one space before something else.
_SPACED = r"(?s)\A(?:{0}|.+(?: |{0})| \z)".format(r"[\t-\r\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def _byte_alphabet() -> dict[int, str]:
    """The characters that byte-level vocabularies write bytes as: printable ones as themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_ALPHABET = _byte_alphabet()


def _model(spec: dict):  # noqa: ANN202
    """The merges alone, for pre-tokens in the byte alphabet; None for a tokenizer that isn't plainly byte-level. Without the library's own
    memory, as each piece comes once."""
    from tokenizers.models import BPE
    model, plain = dict(spec["model"]), {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if spec.get("normalizer") or spec.get("pre_tokenizer") != plain or model.pop("type", None) != "BPE":
        return None
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.pop("merges")]
    return BPE(model.pop("vocab"), merges, cache_capacity=0, **{k: v for k, v in model.items() if v is not None})


def _values(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings without nulls, and where each begins (with the end)."""
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int32)
    at = np.frombuffer(a.buffers()[1], np.int32)[a.offset:a.offset + len(a) + 1]
    data = a.buffers()[2]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data else np.zeros(0, np.uint8), at - at[0]


def _array(kind: pa.DataType, at: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts, and at which each text begins (with the end). Cuts are made where pre-tokens end for certain: before a
    single space and around a single newline between other characters, and before ASCII that is no letter behind a Latin letter."""
    data, at = _values(texts)
    kind = _KIND[data]
    full = np.diff(at) > 0
    first, last = at[:-1][full], at[1:][full] - 1
    kind[last[kind[last] == 1]] = 0
    kind[first] = 0
    cuts = np.zeros(len(data) + 1, bool)
    cuts[at] = True
    behind = np.flatnonzero(kind == 2)
    before = data[behind - 1]
    cuts[behind[_ASCII_LETTER[before]]] = True
    behind = behind[_LATIN2[before]]
    cuts[behind[data[behind - 2] == 0xC3]] = True
    space = np.flatnonzero(kind == 1)
    space = space[_SOLID[data[space + 1]]]
    head = space - 1
    for _ in range(3):
        head -= (data[head] & 0xC0) == 0x80
    space = space[_SOLID[data[head]]]
    cuts[space] = True
    cuts[space[data[space] == 10] + 1] = True
    ends = np.flatnonzero(cuts)
    return _array(pa.string(), ends, data), np.searchsorted(ends, at)


class Tokenizer:
    """Ids of whole texts as the library gives them, remembering the pieces that it has encoded.

    The byte-level pre-tokenizer never joins text across the places where ``cut`` cuts, so the ids of a text are those of its pieces.
    Each distinct piece is encoded by the library: pieces of letters, one pre-token each, by its merges alone, others many in one call
    with a newline between them, those with more white space one by one. Texts with an added token inside go to the library whole, and
    so do all texts of another tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer as Library
        self.library = Library.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.model = _model(spec)
        line = self.library.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None
        self.clear()

    def clear(self) -> None:
        """Forgets all pieces."""
        self.pieces, self.known = pa.array([], pa.string()), pa.array([], pa.binary())

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32).tobytes()

    def _words(self, pieces: list[str]) -> pa.Array:
        """Ids of runs of letters with at most a space before them."""
        space, tokenize = _BYTE_ALPHABET[32], self.model.tokenize
        spelt = [p.replace(" ", space) if p.isascii() else p.encode().decode("latin-1").translate(_BYTE_ALPHABET) for p in pieces]
        found = [[t.id for t in tokenize(p)] for p in spelt]
        at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))])
        return _array(pa.binary(), 4 * at, np.fromiter(chain.from_iterable(found), np.uint32, int(at[-1])))

    def _lines(self, pieces: list[str]) -> pa.Array:
        """Ids of pieces whose only white space is a space at their beginning."""
        found = []
        for i in range(0, len(pieces), 1024):
            part = pieces[i:i + 1024]
            if self.line is None:
                found += map(self._whole, part)
            else:
                ids = np.array(self.library.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, np.uint32)
                at = np.flatnonzero(ids == self.line) * 4
                raw = ids.tobytes()
                found += [raw[a:z] for a, z in zip([0, *(at + 4).tolist()], [*at.tolist(), len(raw)], strict=True)]
        if len(found) != len(pieces):
            raise ValueError("the tokenizer joins text across lines")
        return pa.array(found, pa.binary())

    def _found(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces; new ones are encoded and remembered."""
        at = pc.index_in(pieces, value_set=self.pieces)
        missing = np.flatnonzero(at.is_null())
        if not len(missing):
            return self.known.take(at)
        if len(self.pieces) + len(missing) > MEMORY or self.pieces.nbytes + self.known.nbytes + pieces.nbytes > MEMORY_BYTES:
            # only those of the pieces at hand are kept
            have = at.is_valid()
            self.pieces, self.known = pieces.filter(have), self.known.take(at.drop_null())
            at = np.cumsum(np.asarray(have)) - 1
        else:
            at = at.fill_null(0).to_numpy().copy()
        new = pieces.take(pa.array(missing))
        kind = np.where(pc.match_substring_regex(new, _WORD), 0, np.where(pc.match_substring_regex(new, _SPACED), 2, 1))
        order = np.argsort(kind, kind="stable")
        new = new.take(pa.array(order))
        words, lines, spaced = (new.slice(a, z - a).to_pylist() for a, z in pairwise(np.searchsorted(kind[order], range(4)).tolist()))
        at[missing[order]] = len(self.pieces) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, self._words(words), self._lines(lines), pa.array(list(map(self._whole, spaced)), pa.binary())])
        self.pieces = pa.concat_arrays([self.pieces, new])
        return self.known.take(pa.array(at))

    def encoded(self, texts: pa.Array) -> pa.Array:
        """The ids of each text (no nulls, some MB together) as little-endian 32-bit numbers."""
        whole = np.full(len(texts), self.model is None)
        for s in self.special:
            whole |= np.asarray(pc.match_substring(texts, s))
        if not whole.any():
            pieces, first = cut(texts)
            codes = pieces.dictionary_encode()
            data, at = _values(self._found(codes.dictionary).take(codes.indices))
            return _array(pa.binary(), at[first], data)
        out = np.full(len(texts), b"", object)
        out[~whole] = self.encoded(texts.filter(pa.array(~whole))).to_pylist() if not whole.all() else []
        out[whole] = list(map(self._whole, texts.filter(pa.array(whole)).to_pylist()))
        return pa.array(out, pa.binary())

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        texts = pa.array(texts, pa.string())
        return [x for a, z in _sized(texts) for x in self.encoded(texts.slice(a, z - a)).to_pylist()]


def _sized(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges [from, to) of texts of about ``SLICE_BYTES`` together, a longer one alone."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(total):
        to = max(at + 1, int(np.searchsorted(total, SLICE_BYTES + (total[at - 1] if at else 0), "right")))
        yield at, to
        at = to


def parts(text: str, size: int = 1 << 20) -> list[str]:
    """A long text in pieces that are encoded one by one, cut where no token crosses."""
    out, at = [], 0
    while len(text) - at > size and (m := _SAFE.search(text, at + size)):
        out.append(text[at:m.start()])
        at = m.start()
    return [*out, text[at:]]


def token_ids(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """doc_id, row (unique), n and ids (binary: little-endian 16-bit numbers, or 32-bit if any is larger) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state()
        t = state.get(("tokenizer", tokenizer)) or state.setdefault(("tokenizer", tokenizer), Tokenizer(tokenizer))
        end = np.array([] if end_id is None else [end_id], np.uint32)

        def of_long(text: str) -> pa.Array:
            return pa.array([b"".join(t.ids([text] if t.model is None else parts(text)))], pa.binary())

        for batch in batches:
            for a, z in _sized(batch.column(2)):
                b = batch.slice(a, z - a)
                texts = pc.fill_null(b.column(2).cast(pa.string()), "")
                data, at = _values(of_long(texts[0].as_py()) if z - a == 1 and texts.nbytes > SLICE_BYTES else t.encoded(texts))
                at = at // 4
                ids = np.insert(data.view(np.uint32), np.repeat(at[1:], len(end)), np.tile(end, b.num_rows))
                at = at + len(end) * np.arange(len(at))
                if not len(ids) or ids.max() < 1 << 16:
                    out = _array(pa.binary(), 2 * at, ids.astype(np.uint16))
                else:
                    each = [ids[f:e] for f, e in pairwise(at.tolist())]
                    out = pa.array([(x.astype(np.uint16) if not len(x) or x.max() < 1 << 16 else x).tobytes() for x in each], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.diff(at).astype(np.int64)), out], ["doc_id", "row", "n", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.monotonically_increasing_id().alias(free_name(docs, "row")), text_col).mapInArrow(run, f"doc_id {kind}, row bigint, n bigint, ids binary")


def _joined(column: pa.Array, n: np.ndarray) -> np.ndarray:
    """All ids of a column of ids in one array."""
    parts = column.to_pylist()
    if sum(map(len, parts)) == 2 * n.sum():
        return np.frombuffer(b"".join(parts), np.uint16)
    return np.concatenate([np.frombuffer(x, np.uint16 if len(x) == 2 * k else np.uint32) for x, k in zip(parts, n, strict=True)])


def _counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs, one number for each id of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in slices(batches):
            c = np.bincount(_joined(b.column(1), b.column(0).to_numpy(zero_copy_only=False)))
            if len(c) > len(total):
                total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
            total[:len(c)] += c
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(total[i])], ["id", "n"])

    rows = tokens.select("n", "ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 + max((r[0] for r in rows), default=0), np.int64)
    for i, n in rows:
        out[i] = n
    return out


def _bounds(tokens: DataFrame, files: int) -> list[tuple]:
    """Last (has id, id, row) of each of the ranges of doc_id that become files; one triple for each file."""
    if files <= 1:
        return []
    at = tokens.select("doc_id", "row").repartitionByRange(files, "doc_id", "row").groupBy(F.spark_partition_id().alias("p")).agg(
        F.max(F.struct(F.col("doc_id").isNotNull().cast("int").alias("has"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "row")).alias("x"))
    return sorted(tuple(r[0]) for r in at.select("x").collect())[:-1]


def _head(lengths: np.ndarray) -> bytes:
    used = np.flatnonzero(lengths)
    head = zlib.compress(json.dumps({"block": BLOCK, "ids": used.tolist(), "lengths": lengths[used].tolist()}).encode())
    return MAGIC + struct.pack("<Q", len(head)) + head


def _encoded(tokens: DataFrame, lengths: np.ndarray, bounds: list[tuple]) -> DataFrame:
    """part (the file that a row goes to), doc_id, row, n, bits (its code) and blocks (the bit of each block of it)."""
    raw = lengths.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(np.frombuffer(raw, np.uint8))
        for batch in batches:
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            cuts = np.searchsorted(np.cumsum(sizes), np.arange(CHUNK_IDS, sizes.sum() + CHUNK_IDS, CHUNK_IDS), "left") + 1
            for at, to in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                b = batch.slice(at, max(0, min(to, batch.num_rows) - at))
                if not b.num_rows:
                    continue
                n = b.column(2).to_numpy(zero_copy_only=False)
                ids = _joined(b.column(3), n).astype(np.int64)
                first = np.concatenate([[0], np.cumsum(n)])
                data, start, bit = encoder.encode(ids, first)
                blocks = [bit[f:f + k:BLOCK] - 8 * s for f, k, s in zip(first[:-1], n, start[:-1], strict=True)]
                part = [bisect.bisect_left(bounds, (int(d is not None), d or 0, r)) for d, r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), b.column(0), b.column(1), b.column(2),
                     pa.array([data[s:e] for s, e in zip(start[:-1], start[1:], strict=True)], pa.binary()), pa.array(blocks, pa.list_(pa.int64()))],
                    ["part", "doc_id", "row", "n", "bits", "blocks"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "row", "n", "ids").mapInArrow(run, f"part int, doc_id {kind}, row bigint, n bigint, bits binary, blocks array<bigint>")


def write_ids(tokens: DataFrame, folder: str, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes ``tokens`` (doc_id, row, n, ids) in ascending doc_id order, nulls first, equal ids in the order of the table's rows.

    Returns the manifest, a written table: part (the files' order), path, docs, ids, first (ids of all files before it). Codes come from
    the counts of all ids. Ranges of (doc_id, row) become files, so a doc_id that repeats often spreads over several.
    """
    kind = tokens.schema["doc_id"].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"document ids must be whole numbers, not {kind}")
    total = tokens.agg(F.sum("n")).first()[0] or 0
    files = min(MAX_FILES, max(1, -(-total // file_ids)))
    lengths = code_lengths(_counts(tokens))
    bounds = _bounds(tokens, files)
    head = _head(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, index, size, done = None, None, [], 0, []

        def close() -> None:
            t = pa.Table.from_batches(index)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema) as w:
                w.write_table(t)
            packed = zlib.compress(sink.getvalue())
            place = out.size
            out.write(packed + struct.pack("<QQ", len(packed), place) + MAGIC)
            done.append((now, out.close(), t.num_rows, sum(t.column("n").to_pylist())))

        for b in batches:
            part = b.column(0).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for at, to in zip(edges[:-1], edges[1:], strict=True):
                if at == to:
                    continue
                if part[at] != now:
                    if out is not None:
                        close()
                    out, now, index = Output(folder, ".huf"), int(part[at]), []
                    out.write(head)
                    size = out.size
                rows = b.slice(at, to - at)
                bits = rows.column(4).to_pylist()
                starts = size + np.concatenate([[0], np.cumsum([len(x) for x in bits])])
                out.write(b"".join(bits))
                size = int(starts[-1])
                index.append(pa.RecordBatch.from_arrays([rows.column(1), pa.array(starts[:-1]), rows.column(3), rows.column(5)], ["doc_id", "byte", "n", "blocks"]))
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                                         ["part", "path", "docs", "ids"])

    rows = _encoded(tokens, lengths, bounds).repartitionById(files, F.col("part")).sortWithinPartitions("part", "doc_id", "row")
    manifest = written(rows.mapInArrow(run, "part int, path string, docs bigint, ids bigint"), "manifest")
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("first", F.coalesce(before, F.lit(0)))


def read_file(path: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Documents (doc_id, n) of a file and their ids, some blocks' worth at a time."""
    with open_input(path) as f:
        size = f.size()
        tail = f.read_at(20, size - 20)
        length, place, magic = *struct.unpack("<QQ", tail[:16]), tail[16:]
        lead = f.read_at(12, 0)
        if magic != MAGIC or lead[:4] != MAGIC:
            raise ValueError(f"{path} isn't a complete file of this format")
        head = json.loads(zlib.decompress(f.read_at(struct.unpack("<Q", lead[4:])[0], 12)))
        lengths = np.zeros(1 + max(head["ids"], default=0), np.uint8)
        lengths[head["ids"]] = head["lengths"]
        decoder, block = Decoder(lengths), head["block"]
        index = pa.ipc.open_stream(zlib.decompress(f.read_at(length, place))).read_all().combine_chunks()
        n, byte = index.column("n").to_numpy(), index.column("byte").to_numpy()
        at = 0
        while at < len(n):
            to = max(at + 1, int(np.searchsorted(np.cumsum(n[at:]), 1 << 21)) + at)
            end = int(byte[to]) if to < len(n) else place
            data = f.read_at(end - int(byte[at]), int(byte[at]))
            blocks = index.column("blocks").slice(at, to - at).combine_chunks()
            each = blocks.value_lengths().to_numpy(zero_copy_only=False)
            start = blocks.flatten().to_numpy(zero_copy_only=False) + np.repeat(8 * (byte[at:to] - byte[at]), each)
            ends = np.cumsum(each)
            count = np.full(len(start), block, np.int64)
            last = n[at:to] - (each - 1) * block
            count[ends[each > 0] - 1] = last[each > 0]
            yield index.slice(at, to - at), decoder.decode(data, start, count)
            at = to


def read_ids(manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 (of little-endian 32-bit ids) from the files."""
    kind = "bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for docs, ids in read_file(path):
                    n = docs.column("n").to_numpy()
                    ends = np.cumsum(n)
                    raw = ids.astype("<u4").tobytes()
                    crc = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id").combine_chunks().cast(pa.int64()), pa.array(first + ends - n), pa.array(n), pa.array(crc, pa.int64())],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])
                    first += int(ends[-1])

    files = manifest.select("path", "first")
    return files.repartition(max(1, min(manifest.count(), 1 << 20)), "path").mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")


def stored_ids(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Encodes every row of ``docs`` and writes the ids to files in the shared folder; what ``read_ids`` gives of them.

    ``end_id`` is appended to each document; a null or empty text has no other ids. Special strings inside texts are handled as the library does by
    default. Rows with a null id come first, rows with equal ids follow in the table's order and are returned each; an empty table gives an
    empty result; other columns aren't read.
    """
    tokens = written(token_ids(docs, tokenizer, id_col, text_col, end_id), "token-ids")
    return read_ids(write_ids(tokens, work_folder(docs.sparkSession, "huffman")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return stored_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))

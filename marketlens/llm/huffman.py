"""Canonical length-limited Huffman coding of arrays of ids, vectorised over many blocks."""

from __future__ import annotations

import numpy as np

LIMIT = 18
#: Ids of a block; each block starts at a known bit and is decoded independently.
BLOCK = 4096


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge) for symbols with counts; 0 for those without."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if not len(used):
        return out
    if len(used) == 1:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes of more than {limit} bits")
    weight = counts[used].astype(np.float64)
    order = np.argsort(weight, kind="stable")
    leaf = weight[order]
    # at each level: which of the merged list are leaves, from the deepest level up
    kinds, items = [], leaf
    kinds.append(np.ones(len(leaf), bool))
    for _ in range(limit - 1):
        pairs = items[:len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaf, pairs])
        rank = np.argsort(merged, kind="stable")
        items = merged[rank]
        kinds.append(rank < len(leaf))
    lengths = np.zeros(len(leaf), np.int64)
    take = 2 * len(leaf) - 2
    for kind in reversed(kinds):
        leaves = int(kind[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[used[order]] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of (length, id); they follow from the lengths alone."""
    codes = np.zeros(len(lengths), np.uint32)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    code = last = 0
    step = lengths[order].astype(int).tolist()
    values = []
    for n in step:
        code <<= n - last
        last = n
        values.append(code)
        code += 1
    codes[order] = values
    return codes


class Encoder:
    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths, self.codes = lengths.astype(np.int64), canonical_codes(lengths).astype(np.uint64)

    def encode(self, ids: np.ndarray, first: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bits of ``ids``, most significant first; texts begin at ``first`` (with the end) and at a whole byte each.

        Returns the bytes, the byte at which each text begins (with the end), and the bit at which each id begins.
        """
        n = self.lengths[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        bits = np.diff(ends[first])
        start_byte = np.concatenate([[0], np.cumsum((bits + 7) // 8)])
        at = ends[:-1] + np.repeat(start_byte[:-1] * 8 - ends[first[:-1]], np.diff(first))
        words = np.zeros(int(start_byte[-1]) // 8 + 2, np.uint64)
        if len(ids):
            word, used = at >> 6, (at & 63).astype(np.uint64)
            room = np.uint64(64) - used
            size = n.astype(np.uint64)
            code = self.codes[ids]
            fits = size <= room
            high = np.where(fits, code << (room - np.where(fits, size, room)), code >> (size - np.where(fits, size, room)))
            cut = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            words[word[cut]] = np.bitwise_or.reduceat(high, cut)
            over = np.flatnonzero(~fits)
            words[word[over] + 1] |= code[over] << (np.uint64(64) - (size[over] - room[over]))
        return words.byteswap().tobytes()[:int(start_byte[-1])], start_byte, at


class Decoder:
    """Table-driven: the next ``limit`` bits give the id and how many bits it takes."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.limit = int(lengths.max()) if len(lengths) else 0
        codes, used = canonical_codes(lengths), np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        spans = np.int64(1) << (self.limit - lengths[used].astype(np.int64))
        self.ids = np.zeros(1 << self.limit, np.uint32)
        self.sizes = np.zeros(1 << self.limit, np.uint8)
        fill = int(spans.sum())
        self.ids[:fill] = np.repeat(used, spans)
        self.sizes[:fill] = np.repeat(lengths[used], spans)
        del codes

    def decode(self, data: bytes, start: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The ids of blocks that begin at the bits ``start`` and hold ``count`` ids each, one block after the other."""
        base = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(int(base[-1]), np.uint32)
        raw = data + bytes(8)
        view = np.ndarray(shape=(len(raw) - 3,), dtype=">u4", buffer=raw, strides=(1,))
        order = np.argsort(-count, kind="stable")
        at, to, left = start[order].astype(np.int64), base[:-1][order], count[order]
        shift, live = np.uint32(32 - self.limit), len(order)
        for step in range(int(left[0]) if len(left) else 0):
            while live and left[live - 1] <= step:
                live = int(np.searchsorted(-left, -step, "left"))
            here = at[:live]
            key = (view[here >> 3].astype(np.uint32) << (here & 7).astype(np.uint32)) >> shift
            out[to[:live] + step] = self.ids[key]
            here += self.sizes[key]
        return out

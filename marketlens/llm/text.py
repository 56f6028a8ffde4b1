"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Multiplier of the rolling hashes (odd, so that it has an inverse modulo 2^64).
PRIME = 0x9E3779B97F4A7C15
_INVERSE = pow(PRIME, -1, 1 << 64)
_powers = {PRIME: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers[base]
    if len(have) < n:
        size = max(n, 2 * len(have), 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mixed_bits(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that the table ``is_word`` (256 flags) marks."""
    flag = np.zeros(len(data) + 2, np.int8)
    flag[1:-1] = is_word[data]
    change = np.flatnonzero(np.diff(flag))
    return change[::2], change[1::2]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, size: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of each span's bytes and length; spans ascend. Works through ``size`` bytes at a time."""
    out, at = np.zeros(len(start), np.uint64), 0
    while at < len(start):
        lo = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, lo + size, "right")))
        part = data[lo:int(end[to - 1])]
        s, e = start[at:to] - lo, end[at:to] - lo
        with np.errstate(over="ignore"):
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(PRIME, len(part)), out=total[1:])
            h = (total[e] - total[s]) * powers(_INVERSE, len(part) + 1)[s]
        out[at:to] = mixed_bits(h + (e - s).astype(np.uint64))
        at = to
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive word hashes; empty if there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            h = mixed_bits(h * np.uint64(PRIME) + words[i:len(words) - n + 1 + i])
    return h


def in_blocks(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges [from, to) of texts of about ``size`` bytes together, at least one text each."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield at, i
            at, total = i, 0
        total += len(t) + 1
    if at < len(texts):
        yield at, len(texts)

"""Words and word shingles of many texts at once, as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. Hashes are polynomial in the bytes, taken from one running sum
over the buffer, and mixed; they select, and what they select is verified on the bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BASE = 0x9E3779B97F4A7C15
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32
STRETCH = 1 << 20


@dataclass
class Words:
    """Words of a buffer: start and end byte, hash, and the row each belongs to (rows in order)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    rows: np.ndarray


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(32)


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(STRETCH + 1, BASE), _powers(STRETCH + 1, pow(BASE, -1, 1 << 64))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte slice; slices are in order of start. Equal slices have equal hashes."""
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = int(np.searchsorted(starts, base + STRETCH // 2, side="left"))
        stop = int(ends[first:last].max()) if last > first else base
        if stop - base > STRETCH:  # a slice longer than a stretch is hashed by itself
            for i in range(first, last):
                out[i] = _long_hash(data[starts[i]: ends[i]])
            first = last
            continue
        sums = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((data[base:stop].astype(np.uint64) + np.uint64(1)) * _UP[: stop - base], out=sums[1:])
        lo, hi = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (sums[hi] - sums[lo]) * _DOWN[lo]
        first = last
    return mixed(out)


def _long_hash(data: np.ndarray) -> np.uint64:
    total, scale = np.uint64(0), 1
    for at in range(0, len(data), STRETCH):
        part = data[at: at + STRETCH].astype(np.uint64) + np.uint64(1)
        total = total + (part * _UP[: len(part)]).sum(dtype=np.uint64) * np.uint64(scale)
        scale = scale * pow(BASE, STRETCH, 1 << 64) % (1 << 64)
    return total


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """The words of the texts data[offsets[i]:offsets[i + 1]]; words end with their text."""
    if lower:
        data = TO_LOWER[data]
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(BLANK[data], out=inside[1:-1])
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    joins = offsets[1:-1]
    joins = joins[(joins > 0) & (joins < len(data))]
    both = joins[inside[joins] & inside[joins + 1]]  # texts that touch without a blank
    first[both] = True
    last[both - 1] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return Words(data, starts, ends, slice_hashes(data, starts, ends), rows)


def shingle_hashes(found: Words, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``words`` words of a row; a row with fewer words is one shingle."""
    n = len(found.starts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    firsts = np.flatnonzero(np.r_[True, found.rows[1:] != found.rows[:-1]])
    lengths = np.diff(np.r_[firsts, n])
    short = lengths < words
    full = np.zeros(n, bool)
    if n >= words:
        full[: n - words + 1] = found.rows[: n - words + 1] == found.rows[words - 1:]
    at = np.flatnonzero(full)
    hashes = np.zeros(len(at), np.uint64)
    if len(at):
        for step in range(words):
            hashes = mixed(hashes + found.hashes[at + step])
    extra = []
    for start, length in zip(firsts[short].tolist(), lengths[short].tolist(), strict=True):
        value = np.zeros(1, np.uint64)
        for step in range(length):
            value = mixed(value + found.hashes[start + step: start + step + 1])
        extra.append(value[0])
    return (np.r_[hashes, np.array(extra, np.uint64)], np.r_[found.rows[at], found.rows[firsts[short]]])

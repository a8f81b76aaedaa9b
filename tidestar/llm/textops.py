"""Words, lines and shingles of Arrow string columns, as numpy arrays.

The functions work on one slice of a batch at a time (``slices``), so that the
arrays made for it stay small whatever the size of a batch. Only a single text
longer than ``SLICE_BYTES`` makes a larger slice: its arrays hold a few numbers
for each word of that text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

U64 = np.uint64
# An odd base of the word hash, and the constants of the splitmix64 finaliser.
BASE = 0x9E3779B97F4A7C15
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

# Separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose outputs look independent."""
    x = (x ^ (x >> U64(30))) * MIX_A
    x = (x ^ (x >> U64(27))) * MIX_B
    return x ^ (x >> U64(31))


def mixed(value: int) -> int:
    return int(mix(np.array([value & 0xFFFFFFFFFFFFFFFF], U64))[0])


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWER, _INVERSE = (_powers(b, SLICE_BYTES + 1) for b in (BASE, pow(BASE, -1, 1 << 64)))


@dataclass
class Slice:
    """Some rows of a batch: ``data`` holds their UTF-8 bytes one after another, row i at ``offsets[i]:offsets[i + 1]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_row(self, positions: np.ndarray) -> np.ndarray:
        """Of sorted byte positions: index of the first one in each row, and their number at the end."""
        return np.searchsorted(positions, self.offsets)


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[Slice]:
    """The rows of a string column in order; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, at, raw = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def words(part: Slice, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word, in bytes. No word reaches over the end of a row."""
    inside = ~separator[part.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[part.offsets] = True
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes; the stretches are in order and don't overlap."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        origin = int(starts[i])
        j = int(np.searchsorted(ends, origin + SLICE_BYTES, side="right"))
        if j <= i:  # one stretch longer than a block: its blocks are hashed in turn
            value = U64(0)
            for at in range(origin, int(ends[i]), SLICE_BYTES):
                piece = data[at : min(at + SLICE_BYTES, int(ends[i]))].astype(U64) + U64(1)
                value = mix(np.array([value], U64))[0] + (piece * _POWER[: len(piece)]).sum(dtype=U64)
            out[i] = value + U64(int(ends[i]) - origin)
            i += 1
            continue
        s, e = starts[i:j] - origin, ends[i:j] - origin
        block = data[origin : origin + int(e[-1])].astype(U64) + U64(1)
        sums = np.zeros(len(block) + 1, U64)
        np.cumsum(block * _POWER[: len(block)], out=sums[1:])
        out[i:j] = (sums[e] - sums[s]) * _INVERSE[s] + (e - s).astype(U64)
        i = j
    return mix(out)


def grams(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n neighbouring words; across rows too, which the caller leaves out."""
    count = len(word_hashes) - n + 1
    if count <= 0:
        return np.zeros(0, U64)
    total = np.zeros(count, U64)
    for k in range(n):
        total += word_hashes[k : k + count] * U64(mixed(k + 1) | 1)
    return mix(total)


def shingle_sets(part: Slice, n: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its n-word shingles, letters A-Z in lower case.

    A row of fewer words, but not none, has one shingle: all its words.
    """
    low = Slice(part.first, LOWER[part.data], part.offsets)
    starts, ends = words(low)
    word_hashes = hashes(low.data, starts, ends)
    row = low.per_row(starts)
    every = grams(word_hashes, n)
    for i in range(len(part)):
        a, b = int(row[i]), int(row[i + 1])
        if b - a >= n:
            yield np.unique(every[a : b - n + 1])
        elif b > a:
            yield grams(word_hashes[a:b], b - a) ^ U64(b - a)
        else:
            yield np.zeros(0, U64)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))

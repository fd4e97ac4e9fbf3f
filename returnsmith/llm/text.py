"""Words and shingles of Arrow text columns as numpy arrays, without a Python object per word.

A block of texts is one byte buffer. A word's hash is the difference of two prefix sums of random byte values
times powers of an odd base modulo 2**64, divided by the power at its start, then mixed: equal words have
equal hashes wherever they stand, and different ones collide with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20
SHINGLE = 5


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x + np.uint64((salt * BASE + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_table(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes belong to words: all but those in the given inclusive ranges."""
    table = np.ones(256, bool)
    for low, high in excluded:
        table[low:high + 1] = False
    return table


#: [^\x20\x09-\x0D]+
SPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)])
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of text whose A-Z are lowered
ALNUM = byte_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


class Words(NamedTuple):
    doc: np.ndarray      # row of the block
    start: np.ndarray    # byte offset in the block
    end: np.ndarray
    hash: np.ndarray
    data: np.ndarray     # the block's bytes, lowered if asked
    offsets: np.ndarray  # of the block's rows


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text array; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] \
        if len(texts) else np.zeros(1, np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(n, base & 0xFFFFFFFFFFFFFFFF, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z, other letters as they are."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


class Hasher:
    """Prefix sums of a block: the hash of any byte range in constant time."""

    def __init__(self, data: np.ndarray, salt: int = 0):
        table = mix(np.arange(256, dtype=np.uint64), 7 + salt)
        self.inverse = powers(len(data) + 1, BASE_INVERSE)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * powers(len(data), BASE), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def words(texts: pa.Array, table: np.ndarray, lower: bool = True) -> Words:
    """All words of a block, in order."""
    data, offsets = raw_bytes(texts)
    if lower:
        data = lowered(data)
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]  # a word never crosses rows
    first[edge] = inside[edge]
    last[edge[1:] - 1] = inside[edge[1:] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return Words(doc, start, end, Hasher(data).of(start, end), data, offsets)


def shingles(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, hash) of every run of k words; a row with fewer words has its whole sequence as one."""
    n = len(w.hash)
    g = w.hash[:max(0, n - k + 1)].copy()
    for j in range(1, k):
        g = g * np.uint64(BASE) + w.hash[j:n - k + 1 + j]
    at = np.flatnonzero(w.doc[:len(g)] == w.doc[k - 1:]) if n >= k else np.zeros(0, np.int64)
    g = mix(g[at], k)
    counts = np.bincount(w.doc, minlength=len(w.offsets) - 1)
    begin = np.concatenate(([0], np.cumsum(counts)))[:-1]
    extra_at, extra = [], []
    for m in range(1, k):
        s = begin[counts == m]
        if len(s):
            h = w.hash[s]
            for j in range(1, m):
                h = h * np.uint64(BASE) + w.hash[s + j]
            extra_at.append(s)
            extra.append(mix(h, m))
    if extra:
        at, g = np.concatenate([at, *extra_at]), np.concatenate([g, *extra])
        order = np.argsort(at, kind="stable")
        at, g = at[order], g[order]
    return w.doc[at], at, g


def per_row(rows: np.ndarray, values: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The values of each of n rows; rows ascend."""
    cut = np.searchsorted(rows, np.arange(n + 1))
    for i in range(n):
        yield values[cut[i]:cut[i + 1]]


def blocks(batches: Iterator[pa.RecordBatch], column: str | int = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a block holds about ``limit`` bytes of text; a longer text is a block of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(raw_bytes(batch.column(column))[1])
        low = total = 0
        for i, size in enumerate(sizes):
            if i > low and total + size > limit:
                yield batch.slice(low, i - low)
                low, total = i, 0
            total += size
        yield batch.slice(low)


def doc_ids(column: pa.Array) -> np.ndarray:
    """Ids as int64; null as the smallest value, which no real id has."""
    return column.cast(pa.int64()).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)

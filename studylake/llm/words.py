"""Words of whole texts as 64-bit hashes, a block of Arrow rows at a time.

All word classes used here are closed over UTF-8 bytes, so a word is a run of
bytes and its hash is a difference of prefix sums of a polynomial modulo 2**64.
Memory is bounded by ``BLOCK_BYTES`` or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_ONE = np.uint64(1)

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing: 0-9, a-z and every byte of a longer character
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = _ONE
    return np.multiply.accumulate(out)


class WordHasher:
    """Hashes of the words of a block of texts, with the words' places in rows."""

    def __init__(self, word_bytes: np.ndarray, lower: bool = True):
        self.word_bytes = word_bytes
        self.lower = lower
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word, bounds): row i has the words bounds[i]:bounds[i + 1]."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        offsets = offsets[texts.offset:texts.offset + len(texts) + 1]
        first, last = int(offsets[0]), int(offsets[-1])
        edges = offsets - first
        if last == first:
            return np.empty(0, dtype=np.uint64), np.zeros(len(edges), dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[first:last]
        if self.lower:
            data = LOWER[data]
        inside = self.word_bytes[data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        borders = edges[(edges > 0) & (edges < len(data))]
        starts[borders] = inside[borders]
        ends[borders - 1] = inside[borders - 1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        if len(self.up) < len(data):
            self.up, self.down = _powers(_BASE, len(data)), _powers(_INVERSE, len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + _ONE) * self.up[:len(data)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * self.down[starts]
        hashes = mix(hashes ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))
        return hashes, np.searchsorted(starts, edges)


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about ``limit`` bytes of text; one row may exceed it."""
    sizes = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(sizes.buffers()[1], dtype=np.int64)
    offsets = offsets[sizes.offset:sizes.offset + len(sizes) + 1]
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words, by its first word."""
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + n]
    return mix(out)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column: row i has values[bounds[i]:bounds[i + 1]]."""
    return pa.ListArray.from_arrays(
        pa.array(np.asarray(bounds, dtype=np.int32)), pa.array(values, type=kind))

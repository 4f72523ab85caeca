"""Words and word n-grams of Arrow text batches as numpy arrays.

A word is a maximal run of characters other than space and U+0009-U+000D.  Texts are
handled as UTF-8, where those characters are single bytes, so nothing is decoded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text turned into arrays at a time; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 19

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_GRAM = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text array and the offsets of its rows in them; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offs[0] : offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``limit`` bytes of text."""
    _, offs = text_buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offs, offs[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 2**64))
        done += step
    return out


_UP = _powers(_BASE, 1 << 16)
_DOWN = _powers(_INVERSE, 1 << 16)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        if n > 16 * SLICE_BYTES:  # an exceptional text: do not keep tables of its size
            return _powers(_BASE, n), _powers(_INVERSE, n)
        size = 1 << (n - 1).bit_length()
        _UP, _DOWN = _powers(_BASE, size), _powers(_INVERSE, size)
    return _UP, _DOWN


@dataclass
class Words:
    """``start`` and ``end`` are byte positions in ``data``; row i has words ``rows[i]:rows[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray

    def hashes(self) -> np.ndarray:
        """64-bit values, equal for equal words."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _tables(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))


def words(texts: pa.Array, lower: bool = False) -> Words:
    data, offs = text_buffers(texts)
    if lower:
        data = LOWER[data]
    inside = ~IS_SPACE[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offs[:-1][offs[1:] > offs[:-1]]
        first[full] = inside[full]
        ends = offs[1:][offs[1:] > offs[:-1]] - 1
        last[ends] = inside[ends]
    start = np.flatnonzero(first)
    return Words(data, start, np.flatnonzero(last) + 1, np.searchsorted(start, offs))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Values of the runs of ``n`` consecutive words, row ends not regarded."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out += hashes[k : k + size] * _GRAM[k]
    return mix(out)


def gram_rows(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the ``grams`` that lie within one row, and where each row's begin among these."""
    count = np.maximum(np.diff(rows) - n + 1, 0)
    at = np.zeros(len(rows), np.int64)
    np.cumsum(count, out=at[1:])
    return np.repeat(rows[:-1] - at[:-1], count) + np.arange(at[-1]), at


def row_of(bounds: np.ndarray) -> np.ndarray:
    """For each position the row it lies in."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))

"""Words of Arrow text batches as numpy arrays, without a Python string per word.

A batch's UTF-8 bytes are one array. The white space of the contracts is
ASCII, so word edges are found on bytes. A word's 64-bit value is a polynomial
over its bytes, taken from one running sum for the whole chunk, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = (1 << 20) - (1 << 14)  # bytes of text worked on at once (a longer text alone)

_STEP = np.uint64(0x9E3779B97F4A7C15 | 5)  # odd; odd powers are invertible mod 2**64
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser: spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)


BYTE_VALUES = _byte_values()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(step: int) -> np.ndarray:
        out = np.full(size, step, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    if size not in _KEPT:
        if size > 2 * CHUNK_BYTES:  # a single very long text: not kept
            return run(int(_STEP)), run(pow(int(_STEP), -1, 1 << 64))
        _KEPT[size] = run(int(_STEP)), run(pow(int(_STEP), -1, 1 << 64))
    return _KEPT[size]


@dataclass
class Chunk:
    """Consecutive rows of a batch. ``first[k]:first[k + 1]`` are row k's words."""

    row: int  # index of its first row in the batch
    data: np.ndarray  # bytes
    edges: np.ndarray  # byte offset of each row, and of the end
    start: np.ndarray  # byte offset of each word
    end: np.ndarray
    first: np.ndarray  # index of each row's first word, and of the end

    @property
    def rows(self) -> int:
        return len(self.edges) - 1


def chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a string array (null: no words) in chunks of bounded bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64,
                            count=n + 1, offset=texts.offset * 8) if n else np.zeros(1, np.int64)
    body = texts.buffers()[2] if n else None
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else \
        np.zeros(0, np.uint8)
    k = 0
    while k < n:
        stop = int(np.searchsorted(offsets, offsets[k] + chunk_bytes, side="right")) - 1
        stop = min(max(stop, k + 1), n)
        yield _chunk(k, data[offsets[k]:offsets[stop]], offsets[k:stop + 1] - offsets[k])
        k = stop


def _chunk(row: int, data: np.ndarray, edges: np.ndarray) -> Chunk:
    solid = ~IS_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = edges[1:-1]
    inner = inner[inner < len(data)]
    begins[inner] = solid[inner]  # a word never crosses two rows
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    last = inner[inner > 0] - 1
    ends[last] = solid[last]
    start = np.flatnonzero(begins)
    return Chunk(row, data, edges, start, np.flatnonzero(ends) + 1,
                 np.searchsorted(start, edges))


def word_values(chunk: Chunk, fold: bool = False) -> np.ndarray:
    """A 64-bit value for each word; ``fold`` lower-cases A-Z first."""
    data = LOWER[chunk.data] if fold else chunk.data
    return span_values(data, chunk.start, chunk.end)


def span_values(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Values of the byte spans ``start:end``, equal for equal bytes."""
    if not len(start):
        return np.zeros(0, np.uint64)
    size = 1 << max(16, (len(data) - 1).bit_length())
    power, inverse = _powers(size)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * power[:len(data)], out=total[1:])
    value = (total[end] - total[start]) * inverse[start]
    return mixed(value + (end - start).astype(np.uint64) * _STEP)


def run_values(words: np.ndarray, length: int) -> np.ndarray:
    """Values of all runs of ``length`` consecutive entries of ``words``."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, _ = _powers(1 << 16)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        out += words[k:k + n] * power[k + 1]
    return mixed(out)

"""Words of a batch of texts as NumPy arrays, straight from Arrow buffers.

A word is a maximal run of bytes outside ASCII white space, as ``[^\\x20\\x09-\\x0D]+``.
Each word gets a 64-bit polynomial hash of its bytes from one running sum over the
batch, so that no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SIGNS = _SPACE.copy()
_SIGNS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of text handled at once; one longer document is handled alone.
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_cache: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    if base not in _cache or len(_cache[base]) < n:
        made = _powers(base, max(n, BLOCK_BYTES + 1))
        if n > 8 * BLOCK_BYTES:
            return made
        _cache[base] = made
    return _cache[base][:n]


def text_blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of blocks of about ``size`` bytes; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def split_words(data: np.ndarray, offsets: np.ndarray, signs: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each document (one more at the end).

    With ``signs``, ASCII punctuation separates words as white space does.
    """
    inside = ~(_SIGNS if signs else _SPACE)[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    starts[inner] = inside[inner]
    ends[inner - 1] = inside[inner - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A well-spread 64-bit hash of each word, the same wherever the word stands."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data] if lower else data).astype(np.uint64) * powers(_MULTIPLIER, n) + powers(_MULTIPLIER, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts])


def hash_runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words (``len(words) - length + 1`` of them)."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, length, np.uint64)
    for i in range(length):
        out = out * np.uint64(_MULTIPLIER) + words[i : i + n]
    return mix(out)

"""Word hashes of Arrow text columns, by whole-array numpy steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words between white space.
SOLID = np.ones(256, dtype=bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of digits, letters and anything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the offset of each text, and their end. Null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    if not wide and not pa.types.is_string(column.type):
        column, wide = column.cast(pa.large_string()), True
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of the first word of each text (with the total at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    word = inside[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    cut = at[:-1]
    cut = cut[cut < len(data)]
    first[cut] = word[cut]
    last = word.copy()
    last[:-1] &= ~word[1:]
    end = at[1:] - 1
    end = end[end >= 0]
    last[end] = word[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z lowered, in pieces of bounded size."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    size = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + PIECE, "right")))
        n = int(ends[j - 1] - lo)
        if n > size or not size:
            size = max(1, n, min(PIECE, len(data)))
            up = np.full(size, BASE, np.uint64)
            up[:1] = 1
            up = np.cumprod(up)
            down = np.full(size, INVERSE, np.uint64)
            down[:1] = 1
            down = np.cumprod(down)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((LOWER[data[lo : lo + n]].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mixed((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def groups_of(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes; a longer text stands alone."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
        yield i, j
        i = j


def list_column(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))

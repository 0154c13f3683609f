"""Words of Arrow text columns as numpy arrays: positions and 64-bit hashes, no per-word Python."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from contrail.llm.common import mix64

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = 0x5851F42D4C957F2D
_P_INVERSE = pow(_P, -1, 1 << 64)
#: Bytes hashed at a time: the arrays of powers and sums, which a worker holds or makes anew for each
#: chunk, take about 50 times that.
_CHUNK = 1 << 18


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null is empty."""
    col = column.fill_null("") if column.null_count else column
    col = col.cast(pa.large_utf8())
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def blocks(batch: pa.RecordBatch, column: str = "text", size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, at least one row."""
    _, at = utf8(batch.column(column))
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _P, np.uint64), np.full(n, _P_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@dataclass
class Words:
    """Words of a run of texts, in order: row, byte range in ``data`` and hash (lower case of A-Z)."""

    data: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def text(self, i: int) -> bytes:
        return LOWER[self.data[self.start[i] : self.end[i]]].tobytes()


def split(column: pa.Array) -> Words:
    """Maximal runs of bytes other than space and tab to carriage return, of each text."""
    data, at = utf8(column)
    lo, hi = int(at[0]), int(at[-1])
    starts, ends, hashes = [], [], []
    first = np.zeros(hi - lo + 1, dtype=bool)
    first[at - lo] = True  # texts lie back to back: their first bytes start words too
    while lo < hi:
        cut = min(lo + _CHUNK, hi)
        if cut < hi:  # end the chunk at a break, further on if it has none
            breaks = np.flatnonzero(SPACE[data[lo:cut]] | first[lo - int(at[0]) : cut - int(at[0])])
            breaks = breaks[breaks > 0]
            if len(breaks):
                cut = lo + int(breaks[-1])
            else:
                after = SPACE[data[cut:hi]] | first[cut - int(at[0]) : hi - int(at[0])]
                cut = cut + int(after.argmax()) if after.any() else hi
        b = data[lo:cut]
        begins = first[lo - int(at[0]) : cut - int(at[0])]
        ink = ~SPACE[b]
        before = np.empty_like(ink)
        before[0] = False
        before[1:] = ink[:-1]
        s = np.flatnonzero(ink & (~before | begins))
        after = np.empty_like(ink)
        after[-1] = True
        after[:-1] = ~ink[1:] | begins[1:]
        e = np.flatnonzero(ink & after) + 1
        n = len(b)
        up, down = _powers(max(_CHUNK, 1 << (n - 1).bit_length()))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((LOWER[b].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        h = (total[e] - total[s]) * down[s]
        hashes.append(mix64(h + (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        starts.append(s + lo)
        ends.append(e + lo)
        lo = cut
    empty = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else empty
    return Words(data, np.searchsorted(at, start, side="right") - 1, start,
                 np.concatenate(ends) if ends else empty,
                 np.concatenate(hashes) if hashes else empty.astype(np.uint64))


def shingles(words: Words, n_rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every run of ``n`` words; a row of fewer words gives its whole sequence."""
    rows, h = words.row, words.hash
    total = np.bincount(rows, minlength=n_rows)
    rolled = np.zeros(len(h), np.uint64)
    for k in range(n):
        part = np.zeros(len(h), np.uint64)
        part[: len(h) - k] = h[k:]
        if k:  # a short row's sequence ends with the row
            part[: len(h) - k][rows[k:] != rows[: len(h) - k]] = 0
            part[len(h) - k :] = 0
        rolled = mix64(rolled * np.uint64(0x9FB21C651E98DF25) + part + np.uint64(k + 1))
    first = np.concatenate([[0], np.cumsum(total)[:-1]]) if n_rows else np.zeros(0, np.int64)
    place = np.arange(len(h)) - first[rows] if len(h) else np.zeros(0, np.int64)
    use = (place <= total[rows] - n) | ((place == 0) & (total[rows] < n))
    return rows[use], rolled[use]

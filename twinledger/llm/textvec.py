"""Words, lines and fingerprints of whole texts, computed with numpy over Arrow buffers.

All functions work on a ``Chunk``: the UTF-8 bytes of a run of documents, a few megabytes at a
time (a longer document is a chunk of its own), so memory is bounded by the longest document.
A null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}

#: White space that ends a word: blank, tab, and the line breaks up to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        out = np.full(max(n, CHUNK_BYTES), base, np.uint64)
        out[0] = 1
        _powers[base] = np.multiply.accumulate(out)
    return _powers[base][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range; a fixed, invertible mapping."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@dataclass
class Chunk:
    """``data`` holds the bytes of documents lo..hi-1, ``at`` where each begins, and the end."""

    lo: int
    hi: int
    data: np.ndarray
    at: np.ndarray

    @property
    def docs(self) -> int:
        return self.hi - self.lo

    def owner(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, positions, "right") - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags (one a byte) in each document."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.at[1:]] - total[self.at[:-1]]

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each run of set flags; a run never crosses documents."""
        n = len(inside)
        edge = np.zeros(n + 1, bool)
        edge[self.at] = True
        before = np.concatenate(([False], inside[:-1]))[:n]
        after = np.concatenate((inside[1:], [False]))[:n]
        return (np.flatnonzero(inside & (~before | edge[:-1])),
                np.flatnonzero(inside & (~after | edge[1:])) + 1)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every line, empty ones included."""
        cuts = np.flatnonzero(self.data == 10)
        starts = np.sort(np.concatenate((self.at[:-1], cuts + 1)), kind="stable")
        ends = np.sort(np.concatenate((self.at[1:], cuts)), kind="stable")
        return starts, ends

    def fingerprints(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit value of the bytes of each span; equal bytes give equal values."""
        n = len(self.data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
        value = (total[ends] - total[starts]) * powers(_INVERSE, n + 1)[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; nulls become empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, at


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    if not len(texts):
        return
    data, at = text_buffers(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, len(texts))
        yield Chunk(lo, hi, data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
        lo = hi


def windows(values: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint of each k consecutive values of one document, and where it begins."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[k - 1:])
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD1342543DE82EF95) + values[at + j]
    return mix(out), at


def occurrence(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many equal values stand before each one in its document, and how many there are."""
    n = len(values)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = values ^ mix(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    first = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    starts = np.flatnonzero(first)
    sizes = np.diff(np.append(starts, n))
    seen, count = np.empty(n, np.int64), np.empty(n, np.int64)
    seen[order] = np.arange(n) - np.repeat(starts, sizes)
    count[order] = np.repeat(sizes, sizes)
    return seen, count

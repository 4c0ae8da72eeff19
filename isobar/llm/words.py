"""Words of whole text columns as arrays: byte positions and 64-bit hashes."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# A-Z are read as a-z; a word byte is a digit, a letter or any byte of a
# character beyond ASCII.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True

LONG = 32  # bytes; longer words are hashed one by one
STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed_bits(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """The words of several texts one after the other: word ``i`` is
    ``data[start[i]:end[i]]``, text ``t`` has the words ``first[t]`` to
    ``first[t + 1] - 1``, and ``stop[i]`` is the first word behind word ``i``'s text."""
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def stop(self) -> np.ndarray:
        return np.repeat(self.first[1:], np.diff(self.first))

    def text(self, lo: int, hi: int) -> list[str]:
        """Words ``lo`` to ``hi - 1``, folded."""
        return [self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace") for i in range(lo, hi)]


def words(texts: pa.Array) -> Words:
    """The words of every whole text of a string column; NULL has none."""
    col = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    lo, hi = int(bounds[0]), int(bounds[-1])
    raw = col.buffers()[2]
    data = FOLD[np.frombuffer(raw, np.uint8)[lo:hi]] if raw is not None and hi > lo else np.zeros(0, np.uint8)
    at = bounds - lo
    inside = WORD_BYTE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    edge = at[(at > 0) & (at < len(data))]  # texts that touch do not share a word
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return Words(data, start, end, np.searchsorted(start, at), _hashes(data, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    h = size.astype(np.uint64)
    live = np.flatnonzero(size <= LONG)
    for k in range(LONG):
        live = live[size[live] > k]
        if not len(live):
            break
        h[live] = (h[live] + data[start[live] + k] + np.uint64(1)) * STEP
    for i in np.flatnonzero(size > LONG):
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]], digest_size=8).digest(), "little")
    return mixed_bits(h)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` words in a row (also across texts; the caller leaves those out)."""
    n = max(len(h) - k + 1, 0)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g = (g + h[j:j + n]) * STEP
    return mixed_bits(g)

"""Word hashes and shingle sets of whole texts, over Arrow batches.

Everything works on the UTF-8 bytes of many texts at once: white space is the six
ASCII characters 0x20 and 0x09-0x0D, A-Z count as a-z, and a word is hashed to 64
bits from prefix sums of its bytes, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 19
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
BYTE = np.random.default_rng(20250131).integers(1, MASK, 256, dtype=np.uint64)
STEP = np.random.default_rng(20250201).integers(1, MASK, 64, dtype=np.uint64) | np.uint64(1)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(CHUNK + (1 << 18), n)
        _POWERS[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]), dtype=np.uint64)
                      for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _POWERS[0], _POWERS[1]


@dataclass
class Words:
    """Words of a run of texts: text i has the words ``at[i]:at[i + 1]``."""

    raw: np.ndarray      # the bytes as they are
    data: np.ndarray     # the bytes, A-Z lowered
    offs: np.ndarray     # where each text begins in the bytes
    starts: np.ndarray
    ends: np.ndarray     # one past a word's last byte
    at: np.ndarray
    hashes: np.ndarray

    def text(self, k: int) -> str:
        return self.data[self.starts[k]:self.ends[k]].tobytes().decode("utf-8", "replace")


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about CHUNK bytes: first row, last row + 1, bytes, offsets. Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + CHUNK, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, whole[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def words(raw: np.ndarray, offs: np.ndarray, strip: int = 0) -> Words:
    """The words of a run of texts; up to ``strip`` ASCII punctuation marks are taken off either end of a word."""
    n = len(raw)
    data = LOWER[raw]
    if not n:
        none = np.zeros(0, np.int64)
        return Words(raw, data, offs, none, none, np.zeros(len(offs), np.int64), np.zeros(0, np.uint64))
    gap = SPACE[data]
    first, last = np.empty(n, bool), np.empty(n, bool)
    first[0], first[1:] = True, gap[:-1]
    last[-1], last[:-1] = True, gap[1:]
    first[offs[offs < n]] = True
    last[offs[offs > 0] - 1] = True
    starts, ends = np.flatnonzero(first & ~gap), np.flatnonzero(last & ~gap) + 1
    for _ in range(strip):
        ends = ends - ((ends > starts) & PUNCTUATION[data[ends - 1]])
        starts = starts + ((starts < ends) & PUNCTUATION[data[np.minimum(starts, n - 1)]])
    if strip:
        some = ends > starts
        starts, ends = starts[some], ends[some]
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return Words(raw, data, offs, starts, ends, np.searchsorted(starts, offs), hashes)


def fold(h: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` neighbouring values."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * STEP[k] + h[k:k + n]
    return mix(out)


def shingle_sets(w: Words, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles.

    A text of fewer words has its whole sequence as the only shingle; without words it has none.
    """
    runs = fold(w.hashes, width)
    for i in range(len(w.at) - 1):
        a, b = int(w.at[i]), int(w.at[i + 1])
        if b - a >= width:
            s = np.sort(runs[a:b - width + 1])
            if len(s) > 1:
                s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif b > a:
            s = mix(fold(w.hashes[a:b], b - a) + np.uint64(b - a))
        else:
            s = np.zeros(0, np.uint64)
        yield s

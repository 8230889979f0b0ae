"""Terms of whole texts: runs of ASCII letters and figures and of all characters beyond ASCII."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from . import kernel

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
GAP = np.uint8(0x20)


def terms(raw: np.ndarray, offs: np.ndarray) -> kernel.Words:
    """The terms of a run of texts, A-Z as a-z: whatever is no part of a term counts as a blank."""
    return kernel.words(np.where(TERM[raw], raw, GAP), offs)


def hash_of(word: str) -> int:
    """The hash that ``terms`` gives to a word."""
    data = np.frombuffer(word.encode(), np.uint8)
    found = terms(data, np.array([0, len(data)], np.int64)).hashes
    if len(found) != 1:
        raise ValueError(f"not one term: {word!r}")
    return int(found[0])


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted key among sorted keys, -1 if it isn't there."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``starts[i]:starts[i] + lengths[i]``, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def binaries(values: np.ndarray, cuts: np.ndarray) -> pa.BinaryArray:
    """One binary cell for each ``values[cuts[i]:cuts[i + 1]]``."""
    ends = (np.asarray(cuts) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def joined(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all cells of a binary column, and how many each cell has."""
    parts = [np.frombuffer(x.as_buffer(), dtype) for x in column]
    return np.concatenate([np.zeros(0, dtype), *parts]), np.array([len(p) for p in parts], np.int64)

"""Distinct word shingles of texts, with numpy over whole Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerflow.llm import common

#: A-Z to a-z; everything else stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's distinct shingles (ascending), joined, and
    the bounds per text.  A text of fewer words is one shingle as a whole; a
    text without words has none."""
    at = common.offsets(column)
    raw = LOWER[common.data(column, at)]
    at = at - at[0]
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    solid = ~BLANK[raw]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = at[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    first[inner] |= solid[inner]
    last[inner - 1] |= solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = common.SpanHash(raw).spans(starts, ends)
    bounds = np.searchsorted(starts, at)  # words before each text
    counts = np.diff(bounds)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    long = counts >= size
    heads = common.ragged(bounds[:-1][long], made[long])
    value = np.zeros(len(heads), np.uint64)
    factors = common.random_words(11, size) | np.uint64(1)
    for k in range(size):
        value += words[heads + k] * factors[k]
    value = common.mix64(value)
    total = np.concatenate([[0], np.cumsum(made)])
    out = np.zeros(total[-1], np.uint64)
    out[common.ragged(total[:-1][long], made[long])] = value
    for k in np.flatnonzero((counts > 0) & ~long):
        own = words[bounds[k]:bounds[k + 1]] * factors[:counts[k]]
        out[total[k]] = common.mix64(np.array([own.sum(dtype=np.uint64) + np.uint64(counts[k])], np.uint64))[0]
    sets = [np.unique(out[a:b]) for a, b in zip(total[:-1], total[1:])]
    return np.concatenate(sets) if sets else out, np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def signatures(hashes: np.ndarray, bounds: np.ndarray, coordinates: int) -> np.ndarray:
    """Minimum of each coordinate's permutation over each set: one row of
    unsigned 32-bit values per set (rows of empty sets are zero)."""
    out = np.zeros((len(bounds) - 1, coordinates), np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if not len(full):
        return out
    factors, shifts = common.random_words(23, coordinates) | np.uint64(1), common.random_words(29, coordinates)
    for k in range(coordinates):
        out[full, k] = np.minimum.reduceat((hashes * factors[k] + shifts[k]) >> np.uint64(32), bounds[:-1][full])
    return out

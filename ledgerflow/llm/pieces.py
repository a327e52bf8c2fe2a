"""Token ids of whole texts, piece by piece, for tasks that read Arrow batches.

A piece is one match of the pre-token pattern.  ``PieceEncoder`` splits a
batch with numpy, looks every piece up by its bytes, encodes those it has not
met yet with the function it is given, and joins the ids of all pieces again.
Its memory of pieces is a cache that lives as long as its Python worker and is
bounded in bytes; emptying it changes the time, never the result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Mapping
from itertools import islice, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa

from ledgerflow.llm import common, pretoken

#: Bytes that a worker's memory of pieces may take before it is emptied, and
#: what a piece takes besides its own bytes.
CACHE_BYTES = 96 << 20
PIECE_BYTES = 200


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column's texts, joined, and their bounds.  Texts
    that are not UTF-8 are decoded with U+FFFD for what cannot be read."""
    at = common.offsets(column)
    raw = common.data(column, at)
    try:
        raw.tobytes().decode()
        return raw, at - at[0]
    except UnicodeDecodeError:
        rows = [x.decode("utf-8", "replace").encode() for x in column.to_pylist()]
        return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype(np.int64)


def distinct(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which distinct piece each piece of ``raw`` (bounds ``at``) is, and where
    each of those stands first.  A hash groups them and their bytes decide: if
    two unlike pieces share a hash, all are told apart by their bytes."""
    which, names = pd.factorize(common.SpanHash(raw).spans(at[:-1], at[1:]))
    first = np.zeros(len(names), np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    lengths = np.diff(at)
    # pieces tile the text, so all of it is compared with the first pieces in their places
    if (lengths[first][which] == lengths).all() and (raw[common.ragged(at[first][which], lengths)] == raw[at[0]:at[-1]]).all():
        return which, first
    text = raw.tobytes()
    which, names = pd.factorize(np.array([text[a:b] for a, b in pairwise(at.tolist())], object))
    first = np.zeros(len(names), np.int64)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    return which, first


class PieceEncoder:
    """``encode`` turns a list of distinct pieces (bytes) into their id lists.
    ``tokens``: strings with an id of their own, which are cut out of a text
    before it is split."""

    def __init__(self, encode: Callable[[list[bytes]], Iterable[Iterable[int]]], tokens: Mapping[bytes, int] | None = None, cache: int = CACHE_BYTES):
        self.encode, self.cache, self.tokens = encode, cache, dict(tokens or {})
        self.pattern = re.compile(b"|".join(re.escape(t) for t in sorted(self.tokens, key=len, reverse=True))) if self.tokens else None
        self.clear()

    def clear(self) -> None:
        """Forget all pieces."""
        self.index: dict[bytes, int] = {}
        self.flat, self.starts, self.size = array("I"), array("q", [0]), 0

    def _learn(self, pieces: list[bytes]) -> None:
        plain = iter(self.encode([p for p in pieces if p not in self.tokens]))
        for piece in pieces:
            own = (self.tokens[piece],) if piece in self.tokens else next(plain)
            self.flat.extend(own)
            self.starts.append(len(self.flat))
            self.size += len(piece) + PIECE_BYTES

    def split(self, text: bytes, raw: np.ndarray, breaks: np.ndarray) -> np.ndarray:
        """Bounds of the pieces of the texts that begin at ``breaks``."""
        if self.pattern is None or not self.pattern.search(text):
            return pretoken.split_utf8(raw, breaks[:-1])
        spans = [(m.start() + a, m.end() + a) for a, b in pairwise(breaks.tolist()) for m in self.pattern.finditer(text[a:b])]
        if not spans:  # one that two texts make together
            return pretoken.split_utf8(raw, breaks[:-1])
        low, high = np.array(spans, np.int64).T
        at = pretoken.split_utf8(raw, np.unique(np.concatenate([breaks[:-1], low, high])))
        last = np.searchsorted(low, at, "left") - 1  # the token that begins before a bound
        return at[(last < 0) | (at >= high[np.maximum(last, 0)])]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the column's rows (uint32), and the bounds of each row."""
        raw, breaks = utf8(column)
        text = raw.tobytes()
        at = self.split(text, raw, breaks)
        if self.size > self.cache:
            self.clear()
        index, known = self.index, len(self.index)
        which, first = distinct(raw, at)
        # a piece not met yet gets the next number
        numbers = np.array([index.setdefault(text[a:b], len(index)) for a, b in zip(at[first].tolist(), at[first + 1].tolist())], np.int64)
        if len(index) > known:
            try:
                self._learn(list(islice(reversed(index), len(index) - known))[::-1])
            except BaseException:
                self.clear()  # numbers without ids must not stay
                raise
        starts = np.frombuffer(self.starts, np.int64)
        low, lengths = starts[numbers][which], (starts[numbers + 1] - starts[numbers])[which]
        ids = np.frombuffer(self.flat, np.uint32)[common.ragged(low, lengths)] if len(self.flat) else np.zeros(0, np.uint32)
        del starts  # an array that numpy still looks at cannot grow
        before = np.concatenate([[0], np.cumsum(lengths)])
        return ids, before[np.searchsorted(at, breaks)]

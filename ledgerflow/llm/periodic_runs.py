"""Maximal periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words with smallest period q, at least two periods long,
that no neighbouring word extends.  All runs of a text come out of one pass
over its suffixes:

* positions whose next words stand elsewhere in the text too are put in suffix
  order (ranks of prefixes that double in length), which also gives the longest
  common prefix (LCP) of neighbours in that order;
* neighbours are united by falling LCP, Kruskal's way.  A class of the
  union-find is an ordered set of positions whose suffixes all share that many
  words;
* where a union makes positions i < j adjacent in their class and j - i is at
  most the LCP, the words from i to j + LCP have period j - i.  It is their
  smallest period, since a smaller one would put a position of the same class
  between i and j; it goes no further right, since the LCP ends there; and if
  the words before i and j differ, it goes no further left.  Every run is found
  so, once: by its first position and the one a period on.

Only suffixes that share half of ``MIN_LENGTH`` words can seed a run of that
length, so the union stops there, and a text without repeats costs little more
than numbering its words.  Words are compared as bytes, never by a hash.
Documents are independent: one map pass, no shuffle.

Defined cases: a null, empty or blank text has no words, no runs and an empty
collapsed text; rows that repeat an id are treated one by one; columns not
named in ``keep`` are not read; a text of any length is read whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm import common

#: Words in the shortest run.
MIN_LENGTH = 12
#: Text bytes of one step, so that arrays stay small (a longer text is a step of its own).
STEP_BYTES = 512 << 10


def word_numbers(texts: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, joined, and the bounds of the texts.  Equal words
    of one text share a number; no two texts share one, and another number that
    occurs once ends each text, so that no common prefix leaves its text."""
    numbers: list[int] = []
    bounds, base = [0], 0
    for words in texts:
        known: dict[bytes, int] = {}
        numbers += [base + known.setdefault(w, len(known)) for w in words]
        base += len(known) + 1
        numbers.append(base - 1)
        bounds.append(len(numbers))
    return np.array(numbers, np.int64), np.array(bounds, np.int64)


def _ranks(rank: np.ndarray, by: int) -> np.ndarray:
    """Ranks of the prefixes that go on with the prefix ``by`` places later."""
    later = np.zeros_like(rank)
    later[:len(rank) - by] = rank[by:]
    return np.unique(rank * (int(rank.max()) + 1) + later, return_inverse=True)[1]


def repeated_suffixes(numbers: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose first ``least`` words stand elsewhere too, in suffix
    order, and each one's LCP with the next (0 where it is below ``least``)."""
    none = np.zeros(0, np.int64)
    if len(numbers) <= least:
        return none, none
    levels, rank, span = [], numbers, 1
    while span < least:
        levels.append((span, rank.astype(np.int32)))
        more = min(span, least - span)
        rank, span = _ranks(rank, more), span + more
    sizes = np.bincount(rank)
    active = np.flatnonzero(sizes[rank] > 1)
    if not len(active):
        return none, none
    # a rank is now the place of its class's first member in suffix order; only
    # classes of several members are sorted again, and their places are kept
    rank = (np.cumsum(sizes) - sizes)[rank]
    active = active[np.argsort(rank[active], kind="stable")]
    repeated = len(active)
    order = active
    while len(active):
        levels.append((span, rank.astype(np.int32)))
        # a prefix that stands elsewhere too does not reach its text's end, so the next one exists
        own, following = rank[active], rank[active + span]
        at = np.lexsort((following, own))
        active, own, following = active[at], own[at], following[at]
        index = np.arange(len(active))
        first = np.append(True, own[1:] != own[:-1])
        parted = first.copy()
        parted[1:] |= following[1:] != following[:-1]
        base = np.maximum.accumulate(np.where(first, index, 0))
        head = np.maximum.accumulate(np.where(parted, index, 0))
        rank = rank.copy()
        rank[active] = own + head - base
        alone = parted & np.append(parted[1:], True)
        span, active = 2 * span, active[~alone]
    order = order[np.argsort(rank[order], kind="stable")]
    assert len(order) == repeated
    left, right = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(len(left), np.int64)
    for span, rank in reversed(levels):
        same = np.flatnonzero(rank[left] == rank[right])
        lcp[same] += span
        left[same] += span
        right[same] += span
    lcp[lcp < least] = 0
    return order, np.append(lcp, 0)


def run_seeds(numbers: np.ndarray, order: np.ndarray, lcp: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run in the joined texts: unite
    neighbours in suffix order by falling LCP and read runs off new adjacencies."""
    links = np.flatnonzero(lcp)
    links = links[np.argsort(-lcp[links], kind="stable")].tolist()
    positions, shared, word = order.tolist(), lcp.tolist(), numbers.tolist()
    up = list(range(len(positions)))
    members: list[list[int] | None] = [[p] for p in positions]
    runs = []

    def adjacent(i: int, j: int, common_words: int) -> None:
        period = j - i
        if period <= common_words and common_words + period >= min_length and (i == 0 or word[i - 1] != word[j - 1]):
            runs.append((i, common_words + period, period))

    for k in links:
        a, b, both = k, k + 1, shared[k]
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        while up[b] != b:
            up[b] = up[up[b]]
            b = up[b]
        large, small = members[a], members[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        up[b], members[b] = a, None
        if len(small) == 1:
            x = small[0]
            at = bisect_left(large, x)
            if at:
                adjacent(large[at - 1], x, both)
            if at < len(large):
                adjacent(x, large[at], both)
            large.insert(at, x)
            continue
        gap, last = -1, 0
        for x in small:  # members of one gap are neighbours already: only its ends are new
            at = bisect_left(large, x, max(gap, 0))
            if at != gap:
                if gap >= 0 and gap < len(large):
                    adjacent(last, large[gap], both)
                if at:
                    adjacent(large[at - 1], x, both)
                gap = at
            last = x
        if gap < len(large):
            adjacent(last, large[gap], both)
        members[a] = sorted(large + small)  # two sorted stretches: one merge
    runs.sort(key=lambda r: (r[0], r[2]))
    return runs


def runs_of(texts: Sequence[Sequence[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """``start, length, period`` of each text's runs, by start, then period."""
    numbers, bounds = word_numbers(texts)
    order, lcp = repeated_suffixes(numbers, (min_length + 1) // 2)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    runs = run_seeds(numbers, order, lcp, min_length)
    if runs:
        owner = np.searchsorted(bounds, [r[0] for r in runs], "right") - 1
        for k, (start, length, period) in zip(owner.tolist(), runs):
            found[k].append((start - int(bounds[k]), length, period))
    return found


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()])


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, keep: Sequence[str] = ()) -> DataFrame:
    """``docs``' id and ``keep`` columns with ``n_words``, ``runs`` (array of
    start, length, period; word numbers from 0) and ``collapsed`` (the text
    without what repeats, UTF-8)."""
    names = [id_col, *keep]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.slices(batches, "_raw", STEP_BYTES):
            texts = [raw.split() for raw in piece.column("_raw").to_pylist()]  # at bytes 0x20 and 0x09 to 0x0D
            found = runs_of(texts, min_length)
            bounds = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
            flat = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
            runs = pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(RUN)))
            left = pa.array([collapsed(w, r) for w, r in zip(texts, found)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), pa.array([len(w) for w in texts], pa.int64()), runs, left], [*names, "n_words", "runs", "collapsed"])

    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("_raw"))
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(common.lean(task), f"{kept}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


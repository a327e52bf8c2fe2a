"""Vectorised pre-token split of the public byte-level BPE pattern.

``split`` cuts a text exactly where the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

does, but with numpy over the text's code points instead of a backtracking
scan.  It rests on four facts about the pattern: letters, numbers and other
characters form maximal runs of one class; a run takes one U+0020 before it;
white space before a run loses its last character to a match of its own (or
to the run, if that character is U+0020); and an apostrophe starts a
contraction only where it starts a match.
"""

from __future__ import annotations

import functools
import sys

import numpy as np

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, by the Unicode properties of ``regex``."""
    import regex

    kind = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    text = "".join(map(chr, points))
    for value, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            kind[points[m.start()]:points[m.end() - 1] + 1] = value
    kind[0xD800:0xE000] = OTHER
    return kind


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def split_utf8(raw: np.ndarray, breaks: np.ndarray | None = None) -> np.ndarray:
    """``split`` of valid UTF-8 bytes, with all positions in bytes."""
    text = raw.tobytes().decode()
    if len(text) == len(raw):
        return split(text, breaks)
    first = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    return first[split(text, None if breaks is None else np.searchsorted(first, breaks))]


def split(text: str, breaks: np.ndarray | None = None) -> np.ndarray:
    """Start positions (code points) of the matches, plus the text's length.

    ``breaks``: ascending positions where another text begins, for several
    texts joined into one; no match crosses them.
    """
    points = code_points(text)
    n = len(points)
    if not n:
        return np.zeros(1, np.int64)
    kind = classes()[points]
    fresh = np.zeros(n, bool)
    fresh[0] = True
    if breaks is not None:
        fresh[breaks[breaks < n]] = True
    run = fresh.copy()
    run[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.empty(n, bool)  # last character of its run, with a run after it in the same text
    last[:-1] = run[1:] & ~fresh[1:]
    last[-1] = False
    start = run.copy()
    give = space & last  # the white-space character just before a run of another class
    start |= give
    taken = np.zeros(n, bool)  # runs that take the U+0020 before them
    taken[1:] = give[:-1] & (points[:-1] == 32)
    start &= ~taken
    quote = np.flatnonzero((points == 39) & start & last)
    if len(quote):
        quote = quote[kind[quote + 1] == LETTER]
        padded = np.concatenate([points, np.zeros(2, np.uint32)])
        one, two = padded[quote + 1], padded[quote + 2]
        pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        if len(quote):
            inside = quote + 2 < n
            pair &= inside & ~fresh[np.minimum(quote + 2, n - 1)]
        single = np.isin(one, [115, 116, 109, 100])
        short, long = quote[single], quote[~single & pair]
        start[np.concatenate([short, long]) + 1] = False
        for ends in (short + 2, long + 3):
            ends = ends[ends < n]
            # letters left over go on as a match of their own; anything else already starts one,
            # but for a run that took the space standing here
            start[ends[kind[ends] == LETTER]] = True
    return np.append(np.flatnonzero(start), n)

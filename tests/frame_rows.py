"""Rows of a frame in an order that tests can compare."""

from __future__ import annotations


def _key(t):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in t)


def rows(df, *cols):
    """Collected rows as tuples, sorted with NULLs first."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)

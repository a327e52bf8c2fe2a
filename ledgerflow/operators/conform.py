"""Schema conformance (O4) and conformed unions (O2, O3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.copies import q

Target = Sequence[tuple[str, str]]


def conform(df: DataFrame, target: Target, exprs: Mapping[str, Column | str] | None = None,
            passthrough: bool = True) -> DataFrame:
    """Project ``df`` onto ``target`` ([(name, spark type)]): a provided
    expression (Column or SQL text), or (with ``passthrough``) a same-named
    column, is cast (``try_cast``: bad text -> NULL, D21); anything else
    becomes a typed NULL.  With SQL-text expressions the whole projection is
    one ``selectExpr``."""
    exprs = dict(exprs or {})
    present = set(df.columns) if passthrough else set()
    items: list[Column | str] = []
    for name, dtype in target:
        src = exprs.get(name)
        if src is None and name in present:
            src = f"`{name}`"
        if src is None:
            items.append(f"CAST(NULL AS {dtype}) AS `{name}`")
        elif isinstance(src, str):
            cast = f"CAST(({src}) AS string)" if dtype == "string" else f"TRY_CAST(({src}) AS {dtype})"
            items.append(f"{cast} AS `{name}`")
        else:
            items.append((src.try_cast(dtype) if dtype != "string" else src.cast("string")).alias(name))
    if all(isinstance(i, str) for i in items):
        return df.selectExpr(*items)
    return df.select(*[F.expr(i) if isinstance(i, str) else i for i in items])


def union_conformed(frames: Sequence[DataFrame], target: Target) -> DataFrame:
    """O3: conform every frame, then bag-union by name."""
    return reduce(lambda a, b: a.unionByName(b), [conform(f, target) for f in frames])

"""Skew-safe building blocks for per-key "first row" logic.

A single key, or a group of identical rows, may hold a large share of
all rows.  Window functions put a whole key in one task, so the
operators here are built from combinable aggregates instead:

* ``collapse_copies`` turns identical rows into one row with a count
  (map-side partial aggregation shrinks a hot copy group before the
  shuffle);
* ``expand_copies`` turns counts back into rows, splitting very large
  counts into chunks that are spread over many tasks before exploding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "_copies"
DEFAULT_CHUNK = 1 << 20


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def collapse_copies(df: DataFrame, count_col: str = COPIES) -> DataFrame:
    """Identical rows -> one row plus ``count_col``."""
    return df.groupBy(*[q(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(count_col))


def expand_copies(df: DataFrame, count_col: str = COPIES, chunk: int = DEFAULT_CHUNK, spread: int | None = None) -> DataFrame:
    """Each row -> ``count_col`` copies (the count column is dropped).

    Rows with more than ``chunk`` copies are first cut into chunks, and the
    chunks are redistributed with an explicit partition count (which AQE
    does not coalesce back), so no single task emits a hot group alone.
    """
    n = q(count_col)
    out_cols = [q(c) for c in df.columns if c != count_col]
    cold = df.where(n <= chunk).select(*out_cols, F.explode(F.array_repeat(F.lit(1), n.cast("int"))).alias("_one"))
    hot = df.where(n > chunk)
    parts = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = hot.select(
        *out_cols,
        n.alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long"))).alias("_chunk"),
    ).repartition(parts, F.col("_chunk"), *out_cols[:1])
    hot_rows = chunks.select(
        *out_cols,
        F.explode(F.array_repeat(F.lit(1), F.least(F.lit(chunk), F.col("_n") - F.col("_chunk") * chunk).cast("int"))).alias("_one"),
    )
    return cold.unionByName(hot_rows).drop("_one")


def null_safe_on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """AND of ``left.a <=> right.b`` over the pairs (NULL keys form one group, like GROUP BY)."""
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def order_struct(df: DataFrame, order_cols: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """Struct that orders rows by ``order_cols`` then every other column (total order, NULLs first)."""
    rest = [c for c in df.columns if c not in set(order_cols) and c not in set(exclude)]
    return F.struct(*[q(c).alias(f"o{i}") for i, c in enumerate([*order_cols, *rest])])


def expand_numbered(
    df: DataFrame, base_col: str, count_col: str = COPIES, out_col: str = "_rn", chunk: int = DEFAULT_CHUNK,
    spread: int | None = None,
) -> DataFrame:
    """Each row -> ``count_col`` rows numbered ``base+1 .. base+count`` in ``out_col``.

    Same chunking as :func:`expand_copies`: large counts are split into
    number ranges that are spread over tasks before they are exploded.
    """
    n, base = q(count_col), q(base_col)
    keep = [q(c) for c in df.columns if c not in (count_col, base_col)]
    cold = df.where(n <= chunk).select(*keep, F.explode(F.sequence(base + 1, base + n)).alias(out_col))
    parts = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = df.where(n > chunk).select(
        *keep, base.alias("_b"), n.alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / chunk).cast("long"))).alias("_chunk"),
    ).repartition(parts, F.col("_chunk"))
    lo = F.col("_b") + F.col("_chunk") * chunk + 1
    hi = F.col("_b") + F.least((F.col("_chunk") + 1) * chunk, F.col("_n"))
    hot_rows = hot.select(*keep, F.explode(F.sequence(lo, hi)).alias(out_col))
    return cold.unionByName(hot_rows)

"""Per-key ranking operators (W1-W3) without whole-key windows.

``rank() == 1`` and ``rank() <= 2`` only need the one or two highest
order values per key, which are combinable aggregates; the rows are then
selected with a semi join (AQE splits a skewed key on the big side).
Exact row numbering (W1) uses a range-partitioned global sort, which
spreads a hot key over many tasks, plus per-partition offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir
from ledgerflow.operators.copies import COPIES, DEFAULT_CHUNK, collapse_copies, expand_numbered, null_safe_on, q


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_col: str = "batch_date", rank_col: str | None = None,
    order_key: Column | None = None,
) -> DataFrame:
    """Rows holding the highest ``order_col`` of their key (ties kept),
    i.e. ``rank() over (partition by keys order by order_col desc) = 1``.

    A key whose values are all NULL keeps all its rows (they tie at rank 1).
    ``order_key`` may give a numeric expression with the same order as
    ``order_col`` (e.g. a ``yyyyMMdd`` batch date as a number), which lets
    the per-key maximum use hash aggregation.  ``rank_col`` re-adds the
    constant rank column the reference leaves in its output (D27); by
    default it is not produced.
    """
    keys = list(keys)
    ordered = df.withColumn("_ord", order_key if order_key is not None else q(order_col))
    top = ordered.groupBy(*[q(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_ord").alias("_top"))
    cond = null_safe_on(ordered, top, [(k, f"_k{i}") for i, k in enumerate(keys)]) & ordered["_ord"].eqNullSafe(top["_top"])
    out = ordered.join(top, cond, "left_semi").drop("_ord")
    return out.withColumn(rank_col, F.lit(1)) if rank_col else out


def top_ranks(
    df: DataFrame, keys: Sequence[str], order_col: str, n: int = 2, dense: bool = False
) -> DataFrame:
    """Rows with ``rank() <= n`` (or ``dense_rank() <= n``) by ``order_col``
    desc (NULLs last).

    Rows are counted per (key, value), a combinable aggregate.  Of those
    counts each key's ``n`` highest values are taken with a limited window:
    every task keeps at most ``n`` per key before the shuffle, so neither a
    hot key nor a high-cardinality order column is gathered.  A running
    sum over the ``n`` gives the ranks; the NULL group ranks after all
    values.  The kept (key, value) pairs select the rows with a semi join.
    """
    keys = list(keys)
    kk = [f"_k{i}" for i in range(len(keys))]
    counts = df.groupBy(*[q(k).alias(c) for k, c in zip(keys, kk)], q(order_col).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    falling = Window.partitionBy(*kk).orderBy(F.desc("_v"))
    top = counts.where(F.col("_v").isNotNull()).withColumn("_i", F.row_number().over(falling)).where(F.col("_i") <= n)
    before = F.sum("_c").over(falling.rowsBetween(Window.unboundedPreceding, -1))
    rank = F.col("_i") if dense else F.coalesce(before, F.lit(0)) + 1
    kept = top.withColumn("_rank", rank).where(F.col("_rank") <= n).select(*kk, "_v")
    totals = counts.groupBy(*kk).agg(
        F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))).alias("_nn"), F.count("_v").alias("_dv"),
        F.max(F.col("_v").isNull()).alias("_has_null"))
    null_rank = 1 + (F.col("_dv") if dense else F.coalesce(F.col("_nn"), F.lit(0)))
    kept = kept.unionByName(totals.where(F.col("_has_null") & (null_rank <= n)).select(*kk, F.lit(None).cast(df.schema[order_col].dataType).alias("_v")))
    cond = null_safe_on(df, kept, [(k, c) for k, c in zip(keys, kk)]) & df[order_col].eqNullSafe(kept["_v"])
    return df.join(kept, cond, "left_semi")


def number_within_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    out_col: str = "newr_nqtxn_key",
    prefix_col: str | None = "batch_date",
    chunk: int = DEFAULT_CHUNK,
) -> DataFrame:
    """``row_number() over (partition by keys order by order_by)`` with a
    total-order tie-break, emitted as ``<prefix>_<n>`` (or the bare number).

    Plan: identical rows collapse to counts; the distinct rows are globally
    sorted (range partitioning splits a hot key across tasks) and frozen
    with a reliable checkpoint so partition ids are stable under retries;
    per (partition, key) sums give each partition its starting offset;
    copies expand to consecutive numbers.
    """
    keys = list(keys)
    order_by = list(order_by)
    rest = [c for c in df.columns if c not in set(keys) and c not in set(order_by)]
    distinct = collapse_copies(df)
    sort_cols = [*keys, *order_by, *rest]
    ordered = distinct.orderBy(*[q(c).asc_nulls_first() for c in sort_cols]).withColumn("_pid", F.spark_partition_id())
    ensure_checkpoint_dir(df.sparkSession)  # reads spark.checkpoint.dir; sets one only when unset
    frozen = ordered.checkpoint(eager=True)
    per_part = frozen.groupBy("_pid", *[q(k) for k in keys]).agg(F.sum(COPIES).alias("_part_rows"))
    wk = Window.partitionBy(*[q(k) for k in keys]).orderBy("_pid")
    offsets = per_part.withColumn(
        "_offset", F.coalesce(F.sum("_part_rows").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select(F.col("_pid").alias("_opid"), *[q(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_offset")
    local = Window.partitionBy("_pid", *[q(k) for k in keys]).orderBy(*[q(c).asc_nulls_first() for c in [*order_by, *rest]])
    with_local = frozen.withColumn("_start", F.sum(COPIES).over(local.rowsBetween(Window.unboundedPreceding, -1)))
    cond = (with_local["_pid"] == offsets["_opid"]) & null_safe_on(with_local, offsets, [(k, f"_k{i}") for i, k in enumerate(keys)])
    placed = with_local.join(offsets, cond, "left").select(
        *[q(c) for c in df.columns], COPIES,
        (F.coalesce(F.col("_start"), F.lit(0)) + F.col("_offset")).alias("_base"),
    )
    numbered = expand_numbered(placed, "_base", COPIES, "_rn", chunk)
    label = F.concat(q(prefix_col), F.lit("_"), F.col("_rn").cast("string")) if prefix_col else F.col("_rn").cast("string")
    return numbered.withColumn(out_col, label).drop("_rn")

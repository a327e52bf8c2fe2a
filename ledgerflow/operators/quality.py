"""Data-quality flags and the valid / rejected split (Q1-Q8)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerflow.operators.copies import (
    COPIES,
    DEFAULT_CHUNK,
    collapse_copies,
    expand_copies,
    null_safe_on,
    order_struct,
    q,
)

FLAG = "to_drop"
REMARK = "drop_record_remarks"

# Remarks written with a flag.
REMARK_DUPLICATE = "duplicate record"
REMARK_SMA_BALANCE = "invalid sma fund balance"
REMARK_PLAN_ID = "invalid plan id"

# Plan ids that are never real plans.
INVALID_PLAN_RANGE = ("000001", "000040")
INVALID_NG_PLANS = ("999999", "999998", "999997")


def init_flags(df: DataFrame) -> DataFrame:
    """Add ``to_drop=false`` / ``drop_record_remarks=NULL`` when missing."""
    if FLAG not in df.columns:
        df = df.withColumn(FLAG, F.lit(False))
    if REMARK not in df.columns:
        df = df.withColumn(REMARK, F.lit(None).cast("string"))
    return df


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("batch_date",), chunk: int = DEFAULT_CHUNK
) -> DataFrame:
    """Q1: per key, the first row (by ``order_by`` then all other columns) gets
    ``to_drop=false``; every other row gets ``to_drop=true`` and the remark
    ``duplicate record``.  Nothing is removed.

    Skew-safe plan with one full shuffle: the first row per key is a ``min``
    over a struct (partial aggregation, so a hot key shrinks map-side);
    rows meet their key's winner in a left join that AQE can split.  Rows
    equal to the winner are indistinguishable copies: they are counted
    (again a combinable aggregate) and re-emitted as one kept row plus
    ``n - 1`` flagged ones, in chunks spread over tasks.
    """
    keys = list(keys)
    cols = [c for c in df.columns if c not in (FLAG, REMARK)]
    base = df.select(*[q(c) for c in cols])
    winners = base.groupBy(*[q(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min(order_struct(base, list(order_by), exclude=keys)).alias("_w"))
    winners = winners.hint("merge")  # one row per key: its size follows the data, so no estimate may broadcast it
    joined = base.join(winners, null_safe_on(base, winners, [(k, f"_k{i}") for i, k in enumerate(keys)]), "left")
    is_first = F.coalesce(order_struct(base, list(order_by), exclude=keys).eqNullSafe(F.col("_w")), F.lit(False))
    remark = F.lit(REMARK_DUPLICATE)
    others = joined.where(~is_first).select(*[q(c) for c in cols], F.lit(True).alias(FLAG), remark.alias(REMARK))
    copies = joined.where(is_first).select(*[q(c) for c in cols]).transform(collapse_copies)
    parts = F.array(
        F.struct(F.lit(False).alias("_lf_flag"), F.lit(1).cast("long").alias("_lf_n")),
        F.struct(F.lit(True).alias("_lf_flag"), (q(COPIES) - 1).alias("_lf_n")),
    )
    staged = copies.select(*[q(c) for c in cols], F.inline(parts)).where(F.col("_lf_n") > 0)
    firsts = expand_copies(staged.withColumnsRenamed({"_lf_flag": FLAG, "_lf_n": COPIES}), COPIES, chunk)
    firsts = firsts.withColumn(REMARK, F.when(q(FLAG), remark).otherwise(F.lit(None).cast("string")))
    return others.unionByName(firsts)


def drop_duplicates_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Q7: keep exactly the first row per key (total order: ``order_by`` then all columns).

    One aggregation with a ``min`` over a struct: combinable, so a hot
    key is reduced map-side and never gathered in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in set(keys)]
    ordered = [*order_by, *[c for c in rest if c not in set(order_by)]]
    first = df.groupBy(*[q(k) for k in keys]).agg(F.min(F.struct(*[q(c).alias(c) for c in ordered])).alias("_first"))
    return first.select(*[F.col(f"`_first`.`{c}`").alias(c) if c in rest else q(c) for c in df.columns])


def _flag_when(df: DataFrame, cond: Column, remark: str) -> DataFrame:
    """Set the flag and overwrite the remark where ``cond`` holds (last writer wins)."""
    df = init_flags(df)
    hit = F.coalesce(cond, F.lit(False))
    return df.withColumn(FLAG, F.when(hit, F.lit(True)).otherwise(q(FLAG))).withColumn(
        REMARK, F.when(hit, F.lit(remark)).otherwise(q(REMARK))
    )


def flag_invalid_sma_balance(df: DataFrame, column: str = "sma_fund_balance") -> DataFrame:
    """Q2: a balance containing a blank is rejected."""
    if column not in df.columns:
        return df
    return _flag_when(df, q(column).contains(" "), REMARK_SMA_BALANCE)


def flag_invalid_plan_ids(df: DataFrame) -> DataFrame:
    """Q3: plan id (``plan_id``, else ``plan_number``) in the reserved range
    (string order), or an NG client with one of the reserved NG plans."""
    plan = "plan_id" if "plan_id" in df.columns else "plan_number" if "plan_number" in df.columns else None
    if plan is None:
        return df
    df = _flag_when(df, q(plan).between(*INVALID_PLAN_RANGE), REMARK_PLAN_ID)
    if "client_id" in df.columns:
        df = _flag_when(df, (q("client_id") == "NG") & q(plan).isin(list(INVALID_NG_PLANS)), REMARK_PLAN_ID)
    return df


def valid_rows(df: DataFrame) -> DataFrame:
    """Q4: rows not flagged, without the flag columns."""
    if FLAG not in df.columns:
        return df
    return df.where(~q(FLAG)).drop(FLAG, REMARK)


def rejected_rows(df: DataFrame) -> DataFrame:
    """Q4: flagged rows, flag columns kept."""
    if FLAG not in df.columns:
        return df.limit(0)
    return df.where(q(FLAG))


def observe_counts(df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Q6 without a job of its own: ``df`` with its rows and its rejected rows
    counted by the first action that reads it, and a function that returns
    ``record_count``, ``valid_count`` and ``rejected_count`` once that is done."""
    seen = Observation()
    rejected = F.count_if(q(FLAG)) if FLAG in df.columns else F.lit(0).cast("long")
    watched = df.observe(seen, F.count(F.lit(1)).alias("n"), rejected.alias("bad"))

    def counts() -> dict[str, int]:
        found = seen.get
        return {"record_count": found["n"], "valid_count": found["n"] - found["bad"], "rejected_count": found["bad"]}

    return watched, counts


def record_count(df: DataFrame) -> int:
    """Q6."""
    return df.count()


def distinct_values(df: DataFrame, column: str = "batch_date") -> DataFrame:
    """Q8: distinct values of a column, as a DataFrame."""
    return df.select(q(column)).distinct()

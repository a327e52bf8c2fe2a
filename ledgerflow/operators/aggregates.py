"""Aggregate helpers (A1-A10) built from combinable aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.copies import q

# Account-type spellings that mean "allocated".
ALLOCATED_SPELLINGS = ("ALLOC", "ALOC")
ALLOCATED = "ALLOC"
# Producer role type kept whole.
ROLE_TYPE_WHOLE = "RIA/IAR"


def zero_if_null(c: Column) -> Column:
    """A1 measure: NULL counts as 0."""
    return F.coalesce(c, F.lit(0))


def canonical_account_type(c: Column) -> Column:
    """A5 mapping: ALLOC/ALOC (any case, padded) -> ALLOC, else unchanged."""
    return F.when(F.upper(F.trim(c)).isin(list(ALLOCATED_SPELLINGS)), F.lit(ALLOCATED)).otherwise(c)


def role_type_code(c: Column) -> Column:
    """A6 mapping: keep RIA/IAR whole, else the first three characters."""
    return F.when(c == ROLE_TYPE_WHOLE, c).otherwise(F.substring(c, 1, 3))


def distinct_concat(df: DataFrame, keys: Sequence[str], values: dict[str, Column], sep: str = ";") -> DataFrame:
    """Per key, ``concat_ws(sep, sorted distinct non-empty values)`` for each output.

    One ``groupBy`` with ``collect_set``: partial aggregation de-duplicates
    map-side, so a hot key ships only its distinct values through the single
    shuffle.  Sorting makes the string deterministic.
    """
    return df.groupBy(*[q(k) for k in keys]).agg(*[
        F.concat_ws(sep, F.array_sort(F.collect_set(F.nullif(expr, F.lit(""))))).alias(name)
        for name, expr in values.items()
    ])


def allocation_summary(df: DataFrame, keys: Sequence[str], account_col: str) -> DataFrame:
    """A5 without materialising sets: per key the count, min and max of the
    canonical account types (enough to test "the set is exactly {ALLOC}")."""
    v = canonical_account_type(q(account_col))
    return df.groupBy(*[q(k) for k in keys]).agg(
        F.count(v).alias("_acct_n"), F.min(v).alias("_acct_min"), F.max(v).alias("_acct_max")
    )


def unallocated_flag(n: Column, lo: Column, hi: Column, empty_is_null: bool = False) -> Column:
    """A8: 'N' when the set is exactly {ALLOC}; NULL for an empty set when
    ``empty_is_null`` (division variant); otherwise 'Y' (also with no set)."""
    only_alloc = (lo == ALLOCATED) & (hi == ALLOCATED)
    flag = F.when(only_alloc, F.lit("N"))
    if empty_is_null:
        flag = flag.when(n == 0, F.lit(None).cast("string"))
    return flag.otherwise(F.lit("Y"))


def first_code(df: DataFrame, key: str, value: str, out: str, length: int = 3) -> DataFrame:
    """One code per key: the smallest value's first ``length`` characters."""
    return df.groupBy(q(key)).agg(F.substring(F.min(q(value)), 1, length).alias(out))

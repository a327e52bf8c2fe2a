"""Table scans: catalog tables and path tables, with pushed-down predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def predicate(conditions: Mapping[str, object]) -> Column | None:
    """AND of ``col = value`` (scalar) and ``col IN (...)`` (list/tuple/set).

    Built with the Column API, so values need no quoting and reach the
    scan as partition filters / pushed filters.  Unsupported value types
    raise instead of being dropped (D18).
    """
    parts = []
    for name, value in conditions.items():
        if isinstance(value, (list, tuple, set, frozenset)):
            parts.append(F.col(name).isin(list(value)))
        elif isinstance(value, (str, int, float, bool)):
            parts.append(F.col(name) == F.lit(value))
        else:
            raise TypeError(f"unsupported predicate value for {name!r}: {type(value).__name__}")
    return reduce(lambda a, b: a & b, parts) if parts else None


def read_table(spark: SparkSession, table: str, conditions: Mapping[str, object] | None = None) -> DataFrame:
    """``database.table`` from the catalog, filtered."""
    df = spark.table(table)
    cond = predicate(conditions or {})
    return df.where(cond) if cond is not None else df


def read_path_table(
    spark: SparkSession, path: str, conditions: Mapping[str, object] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A table stored at a path (parquet by default), filtered."""
    df = spark.read.format(fmt).load(path)
    cond = predicate(conditions or {})
    return df.where(cond) if cond is not None else df


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def union_channels(frames: Sequence[DataFrame]) -> DataFrame:
    """O2/O3: bag union by column name over any number of frames."""
    return reduce(lambda a, b: a.unionByName(b), frames)

"""Row-level cleansing projections.

Every function is a single projection over the frame: no shuffle, and the
expressions stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

# Cycle-date columns filled from the batch date when empty.
CYCLE_DATE_COLUMNS = ("dss_cycle_date", "source_cycle_date", "cycle_date", "prx_cycle_date", "run_date", "valuation_date")

# Defaults for empty codes.
DEFAULT_REV_CODE = "0"
DEFAULT_CLIENT_ID = "NG"
DEFAULT_LOAN_TYPE = "G"

# Loan fund remap (fund_iv -> code).
LOAN_FUND_CODES = {"90": "LN90", "91": "LN91"}

# Beneficiary type labels.
BENEFICIARY_LABELS = {"1": "Individual", "2": "Organization", "3": "Trust"}
BENEFICIARY_OTHER = "Unknown"

# Sentinel used for missing string keys.
NULL_KEY = "-9999"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _string_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}


def junk_free(c: Column) -> Column:
    """C2 on one column: '' -> NULL, each CR/LF -> one blank."""
    return F.regexp_replace(F.nullif(c, F.lit("")), r"[\n\r]", " ")


def remove_junk_values(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Apply :func:`junk_free` to every string column (or the given ones).

    Non-string columns cannot hold blanks or line breaks and keep their type.
    """
    targets = set(columns) if columns is not None else _string_columns(df)
    return df.select([junk_free(_q(c)).alias(c) if c in targets else _q(c) for c in df.columns])


def batch_date_iso(batch_date: str) -> Column:
    """``yyyyMMdd`` job argument as an ISO date string column."""
    return F.to_date(F.lit(batch_date), "yyyyMMdd").cast("string")


def fill_cycle_dates(df: DataFrame, batch_date: str, columns: Sequence[str] = CYCLE_DATE_COLUMNS) -> DataFrame:
    """NULL cycle dates (named columns, when present) -> batch date as ``yyyy-MM-dd``."""
    present = set(columns)
    fill = batch_date_iso(batch_date)
    return df.select([F.coalesce(_q(c), fill).alias(c) if c in present else _q(c) for c in df.columns])


def with_default(c: Column, default: str) -> Column:
    """C9 on one column: NULL or '' -> default."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Replace NULL/'' with a default, for the named columns that exist."""
    return df.select([with_default(_q(c), defaults[c]).alias(c) if c in defaults else _q(c) for c in df.columns])


def fill_rev_code(df: DataFrame) -> DataFrame:
    return fill_defaults(df, {"rev_code": DEFAULT_REV_CODE})


def fill_client_id(df: DataFrame) -> DataFrame:
    return fill_defaults(df, {"client_id": DEFAULT_CLIENT_ID})


def fill_loan_type(df: DataFrame) -> DataFrame:
    return fill_defaults(df, {"loan_type_id": DEFAULT_LOAN_TYPE})


def loan_fund_remap(source: Column, current: Column) -> Column:
    """C12 on one column: fund_iv 90/91 -> LN90/LN91, else the current value."""
    expr = None
    for code, label in LOAN_FUND_CODES.items():
        expr = F.when(source == code, F.lit(label)) if expr is None else expr.when(source == code, F.lit(label))
    return expr.otherwise(current)


def remap_loan_funds(df: DataFrame, target: str, source: str = "fund_iv") -> DataFrame:
    """Rewrite ``target`` (fund_code for ng, price_id for jb) from ``fund_iv``."""
    return df.withColumn(target, loan_fund_remap(_q(source), _q(target)))


def beneficiary_label(c: Column) -> Column:
    """Beneficiary type code -> label."""
    expr = None
    for code, label in BENEFICIARY_LABELS.items():
        expr = F.when(c == code, F.lit(label)) if expr is None else expr.when(c == code, F.lit(label))
    return expr.otherwise(F.lit(BENEFICIARY_OTHER))


def trim_string_columns(df: DataFrame) -> DataFrame:
    """Trim string columns; other types pass through unchanged."""
    strings = _string_columns(df)
    return df.select([F.trim(_q(c)).alias(c) if c in strings else _q(c) for c in df.columns])


def stub_null_keys(df: DataFrame, keys: Sequence[str], date_default: Column | None = None) -> DataFrame:
    """C14: NULL key -> sentinel by type ('-9999' strings, -9999 numbers, current date for dates)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    date_fill = date_default if date_default is not None else F.current_date()
    keyset = set(keys)

    def stub(c: str) -> Column:
        t = types[c]
        if isinstance(t, StringType):
            fill = F.lit(NULL_KEY)
        elif isinstance(t, DateType):
            fill = date_fill
        elif isinstance(t, (TimestampType, TimestampNTZType)):
            fill = date_fill.cast(t)
        elif isinstance(t, NumericType):
            fill = F.lit(int(NULL_KEY)).cast(t)
        else:
            return _q(c)
        return F.coalesce(_q(c), fill).alias(c)

    return df.select([stub(c) if c in keyset else _q(c) for c in df.columns])


def add_operation_column(df: DataFrame, op_code_col: str = "seq_oper_code", out: str = "delta_op") -> DataFrame:
    """C17: operation stamp for downstream consumers: 'D' rows delete, the rest upsert."""
    return df.withColumn(out, F.when(_q(op_code_col) == "D", F.lit("D")).otherwise(F.lit("U")))

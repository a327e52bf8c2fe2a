"""Date normalisation (C4-C6) and the receive-time batch-date rule.

All parsing goes through ``try_to_date`` / ``try_to_timestamp`` so a bad
value becomes NULL instead of failing the job under ANSI mode, and one
``select`` handles every date column (no per-pattern ``withColumn`` chain).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Strings that mean "no date".
INVALID_DATE_STRINGS = (
    "0000-00-00", "0000.00.00", "0000/00/00",
    "00-00-0000", "00.00.0000", "00/00/0000",
    "00-00-00", "00.00.00", "00/00/00",
    "0000-00-00 00:00:00", "0000-00-00T00:00:00.000-0000", "0000-00-00T00:00:00.000-00:00",
    "00000000",
)

# Accepted date patterns, in priority order (first match wins).
DATE_PATTERNS = (
    "yyyy-MM-dd", "yyyy.MM.dd", "yyyy/MM/dd",
    "MM-dd-yyyy", "MM.dd.yyyy", "MM/dd/yyyy",
    "MM-dd-yy", "MM.dd.yy", "MM/dd/yy",
    "dd-MM-yyyy", "dd.MM.yyyy", "dd/MM/yyyy",
    "dd-MM-yy", "dd.MM.yy", "dd/MM/yy",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSZ",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyyMMdd",
)
# Patterns carrying a zone offset: the date is their literal first ten
# characters, so the result does not depend on the session time zone.
ZONED_PATTERNS = frozenset({"yyyy-MM-dd'T'HH:mm:ss.SSSZ", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"})

# Name fragments that mark a date column, and the exception.
DATE_NAME_MARKERS = ("date", "_dt", "_dob")
DATE_NAME_EXCLUDED = ("batch_date",)

# Receive-time cut-off (HH:mm) separating same-day and previous-day batches.
CUTOFF_SAME_DAY = ("14:59", "23:59")
CUTOFF_PREVIOUS_DAY = ("00:00", "14:58")
CUTOFF_CYCLE_COLUMNS = ("dss_cycle_date", "source_cycle_date", "cycle_date", "prx_cycle_date", "run_date",
                        "valuation_date", "as_of_date")


def invalid_date_to_null(c: Column) -> Column:
    """C4: shorter than 8 characters or a zero-date sentinel -> NULL."""
    return F.when((F.length(c) < 8) | c.isin(list(INVALID_DATE_STRINGS)), F.lit(None).cast("string")).otherwise(c)


def pattern_shape(pattern: str) -> str:
    """Regex accepting every string ``pattern`` could parse (and more): a cheap
    guard so the parser, which fails by raising, only sees plausible input."""
    tokens = (("yyyy", "[+-]?[0-9]{4,}"), ("yy", "[0-9]{2}"), ("MM", "[0-9]{2}"), ("dd", "[0-9]{2}"),
              ("HH", "[0-9]{2}"), ("mm", "[0-9]{2}"), ("ss", "[0-9]{2}"), ("SSS", "[0-9]{3}"),
              ("XXX", "(Z|[+-][0-9]{2}:[0-9]{2})"), ("Z", "[+-][0-9]{4}"))
    out, i = "(?i)^", 0
    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            out += re.escape(pattern[i + 1:j])
            i = j + 1
            continue
        for tok, rx in tokens:
            if pattern.startswith(tok, i):
                out += rx
                i += len(tok)
                break
        else:
            out += re.escape(pattern[i])
            i += 1
    return out + "$"


def parse_date(c: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """First pattern that parses, as a DATE; unparsable -> NULL.

    Each attempt is guarded by the pattern's shape, so a value costs one
    or two real parse attempts instead of up to nineteen failed ones.
    """
    attempts = []
    for p in patterns:
        fits = c.rlike(pattern_shape(p))
        if p in ZONED_PATTERNS:
            ok = F.try_to_timestamp(c, F.lit(p)).isNotNull()
            attempts.append(F.when(fits & ok, F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")))
        else:
            attempts.append(F.when(fits, F.try_to_date(c, p)))
    return F.coalesce(*attempts)


def normalized_date(c: Column) -> Column:
    """C4 + C5 as one expression, rendered as an ISO ``yyyy-MM-dd`` string."""
    return parse_date(invalid_date_to_null(c)).cast("string")


def date_columns(columns: Sequence[str], explicit: Sequence[str] | None = None) -> list[str]:
    """Columns to normalise.  An explicit list wins over the name rule."""
    if explicit is not None:
        return [c for c in columns if c in set(explicit)]
    return [
        c for c in columns
        if any(m in c for m in DATE_NAME_MARKERS) and c not in DATE_NAME_EXCLUDED
    ]


def normalize_date_columns(df: DataFrame, explicit: Sequence[str] | None = None) -> DataFrame:
    """C4-C6 in one projection.  Normalised columns move to the end, in column order."""
    targets = date_columns(df.columns, explicit)
    keep = [F.col(f"`{c}`") for c in df.columns if c not in targets]
    fixed = [normalized_date(F.col(f"`{c}`")).alias(c) for c in targets]
    return df.select(*keep, *fixed)


def batch_date_by_cutoff(df: DataFrame, recv_date: str, recv_time: str, cycle_columns: Sequence[str] = CUTOFF_CYCLE_COLUMNS) -> DataFrame:
    """Derive ``batch_date`` (yyyyMMdd) from the file receive date/time.

    Without a cycle column: received in the same-day window -> receive
    date, in the early window -> the day before.  With the first present
    cycle column: rows whose cycle date is not 10 characters are dropped;
    a cycle date equal to the receive date uses the same cut-off, an
    earlier one is kept as is, a later one falls back to the receive date
    rule.
    """
    recv = F.to_date(F.lit(recv_date), "yyyyMMdd")
    t = F.lit(recv_time)
    same_day = (t >= CUTOFF_SAME_DAY[0]) & (t <= CUTOFF_SAME_DAY[1])
    prev_day = (t >= CUTOFF_PREVIOUS_DAY[0]) & (t <= CUTOFF_PREVIOUS_DAY[1])
    by_recv = (
        F.when(same_day, F.date_format(recv, "yyyyMMdd"))
        .when(prev_day, F.date_format(F.date_sub(recv, 1), "yyyyMMdd"))
    )
    cycle = next((c for c in cycle_columns if c in df.columns), None)
    if cycle is None:
        return df.withColumn("batch_date", by_recv)
    cdate = F.try_to_date(F.col(cycle), "yyyy-MM-dd")
    by_cycle = (
        F.when(cdate == recv, F.when(same_day, F.date_format(cdate, "yyyyMMdd"))
               .when(prev_day, F.date_format(F.date_sub(cdate, 1), "yyyyMMdd")))
        .when(cdate < recv, F.date_format(cdate, "yyyyMMdd"))
        .otherwise(by_recv)
    )
    return df.where(F.length(F.col(cycle)) == 10).withColumn("batch_date", by_cycle)


def month_end(c: Column) -> Column:
    """Last day of the month of a date-like value."""
    return F.last_day(c.try_cast("date"))


def capped_cycle_date(c: Column) -> Column:
    """Cycle date string later than 9999-12-31 -> NULL, else the date."""
    return F.when(c > F.lit("9999-12-31"), F.lit(None).cast("date")).otherwise(c.try_cast("date"))

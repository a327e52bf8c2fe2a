"""Signed-overpunch amount decoding.

A mainframe amount arrives as ``precision`` digits without a decimal
point; a negative value carries its last digit as a letter.  Decoding is
one expression per column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.cleansing import fill_rev_code

# Trailing letters meaning "negative, last digit 0..9".
NEGATIVE_LAST_DIGIT = "pqrstuvwxy"
DIGITS = "0123456789"

# Transaction amount columns -> (precision, scale).
TXN_AMOUNTS = {
    "cash": (13, 2),
    "shares": (13, 4),
    "uninvested_cash": (13, 2),
    "share_cost": (13, 2),
    "other_cash": (13, 2),
    "share_price": (13, 6),
    "currency_value": (13, 2),
    "xr_rate": (11, 6),
    "net_currency_value": (13, 2),
}


def decode_overpunch(c: Column, precision: int, scale: int) -> Column:
    """Insert the decimal point after ``precision - scale`` characters;
    a trailing p..y means negative with last digit 0..9 (only the last
    character is rewritten, D29).  Other values keep their characters;
    NULL stays NULL.  The result is a string, cast by the entity layer.
    """
    whole = precision - scale
    dotted = F.concat(F.substring(c, 1, whole), F.lit("."), F.substring(c, whole + 1, precision))
    last = F.substring(dotted, -1, 1)
    body = F.left(dotted, F.length(dotted) - F.lit(1))
    negative = F.concat(F.lit("-"), body, F.translate(last, NEGATIVE_LAST_DIGIT, DIGITS))
    return F.when(F.instr(F.lit(NEGATIVE_LAST_DIGIT), last) > 0, negative).otherwise(dotted)


def decode_amounts(df: DataFrame, amounts: Mapping[str, tuple[int, int]]) -> DataFrame:
    """C10 over several columns in one projection (columns absent are skipped)."""
    return df.select([
        decode_overpunch(F.col(f"`{c}`"), *amounts[c]).alias(c) if c in amounts else F.col(f"`{c}`")
        for c in df.columns
    ])


def parse_txn_amounts(df: DataFrame) -> DataFrame:
    """C11: decode the nine transaction amounts and default an empty rev_code to '0'."""
    return fill_rev_code(decode_amounts(df, TXN_AMOUNTS))

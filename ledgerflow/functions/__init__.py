"""Column-level functions: cleansing (C), dates (C4-C6, C15), amounts."""

from ledgerflow.functions.amounts import TXN_AMOUNTS, decode_amounts, decode_overpunch, parse_txn_amounts
from ledgerflow.functions.cleansing import (
    CYCLE_DATE_COLUMNS,
    NULL_KEY,
    add_operation_column,
    batch_date_iso,
    beneficiary_label,
    fill_client_id,
    fill_cycle_dates,
    fill_defaults,
    fill_loan_type,
    fill_rev_code,
    junk_free,
    loan_fund_remap,
    remap_loan_funds,
    remove_junk_values,
    stub_null_keys,
    trim_string_columns,
    with_default,
)
from ledgerflow.functions.dates import (
    DATE_PATTERNS,
    INVALID_DATE_STRINGS,
    batch_date_by_cutoff,
    capped_cycle_date,
    date_columns,
    invalid_date_to_null,
    month_end,
    normalize_date_columns,
    normalized_date,
    parse_date,
)

__all__ = [name for name in dir() if not name.startswith("_")]

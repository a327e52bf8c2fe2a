"""Relational operators: quality flags (Q), windows (W), joins (J),
aggregates (A), conformance (O) and MERGE (K5-K8, K11)."""

from ledgerflow.operators.aggregates import (
    allocation_summary,
    canonical_account_type,
    distinct_concat,
    first_code,
    role_type_code,
    unallocated_flag,
    zero_if_null,
)
from ledgerflow.operators.conform import conform, union_conformed
from ledgerflow.operators.copies import collapse_copies, expand_copies, expand_numbered
from ledgerflow.operators.joins import (
    broadcast_if_small,
    dealt_join,
    heavy_keys,
    keep_latest_batches,
    latest_batches,
    merge_frames,
    prefix,
    rule_join,
    sentinel,
    sentinel_on,
)
from ledgerflow.operators.merge import (
    Clause,
    MergeSpec,
    delete_matching,
    delete_only_spec,
    key_rewrite_spec,
    merge_frame,
    rewrite_keys,
    upsert_spec,
)
from ledgerflow.operators.quality import (
    distinct_values,
    drop_duplicates_by_key,
    flag_duplicates,
    flag_invalid_plan_ids,
    flag_invalid_sma_balance,
    init_flags,
    observe_counts,
    record_count,
    rejected_rows,
    valid_rows,
)
from ledgerflow.operators.windows import latest_per_key, number_within_key, top_ranks

__all__ = [name for name in dir() if not name.startswith("_")]

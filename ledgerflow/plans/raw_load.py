"""Staging -> raw job for one feed and batch.

Reads the batch from the staging table, cleanses, normalises dates,
flags bad rows, splits valid / rejected, writes both (rejected by
dynamic partition overwrite, valid by overwrite or MERGE), applies
participant-id changes for incremental feeds (T9) and records an audit
row with the counts of all, valid and rejected rows.  The valid/rejected
frames come from one persisted frame.  An
incremental load and its id changes are one write of the table, old
versions beyond ``keep_versions`` go, and with a ``database`` the tables
are registered in the catalog under the feed's table name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.amounts import parse_txn_amounts
from ledgerflow.functions.cleansing import fill_client_id, fill_cycle_dates, fill_loan_type, remap_loan_funds, remove_junk_values
from ledgerflow.functions.dates import normalize_date_columns
from ledgerflow.operators.joins import written
from ledgerflow.operators.merge import rewrite_keys, upsert_spec
from ledgerflow.operators.quality import (
    flag_duplicates,
    flag_invalid_plan_ids,
    flag_invalid_sma_balance,
    observe_counts,
    rejected_rows,
    valid_rows,
)
from ledgerflow.operators.windows import number_within_key
from ledgerflow.plans.id_rewrite import id_changes as id_change_rows, id_changes_for
from ledgerflow.sinks import buckets, writers

# File-name markers that switch feed-specific steps on.
UNIQUE_KEY_FILE = "TRANSACTION_VNQ_WC.TXT"
UNIQUE_KEY_COLUMN = "newr_nqtxn_key"
SMA_BALANCE_MARKER = "EXN.XXEWRE01.XXEWRPTD"
PLAN_ID_PREFIXES = ("SUPER_OMNI", "EXN.")
TXN_AMOUNT_MARKERS = ("SEQHIST", "EXN.XXEWRE01.XXEWRTRXH")
CLIENT_DEFAULT_MARKER = "SSN.OUTPUT"
LOAN_TYPE_MARKER = "EXN.XXEWRE01.XXEWRPPL"
FUND_REMAP_FILES = {"EXN.XXEWRE01.XXEWRPFD.NG": "fund_code", "EXN.XXEWRE01.XXEWRPFD.JB": "price_id"}
SEQHIST_MARKER = "SEQHIST"


@dataclass(frozen=True)
class FeedRules:
    """Which feed-specific steps run.  ``rules_for_file`` derives them from a
    file name the way the feeds are named; tests and callers may set them."""

    unique_key: bool = False
    flag_sma_balance: bool = False
    flag_plan_ids: bool = False
    txn_amounts: bool = False
    default_client: bool = False
    default_loan_type: bool = False
    fund_remap_target: str | None = None
    seqhist: bool = False


def rules_for_file(file_name: str) -> FeedRules:
    return FeedRules(
        unique_key=file_name == UNIQUE_KEY_FILE,  # equality, not substring (D10)
        flag_sma_balance=SMA_BALANCE_MARKER in file_name,
        flag_plan_ids=file_name.startswith(PLAN_ID_PREFIXES),
        txn_amounts=any(m in file_name for m in TXN_AMOUNT_MARKERS),
        default_client=CLIENT_DEFAULT_MARKER in file_name,
        default_loan_type=LOAN_TYPE_MARKER in file_name,
        fund_remap_target=FUND_REMAP_FILES.get(file_name),
        seqhist=SEQHIST_MARKER in file_name,
    )


@dataclass(frozen=True)
class FeedParams:
    source_name: str
    file_name: str
    table_name: str
    file_load: str = "full_load"  # or "incremental"
    primary_keys: Sequence[str] | None = None
    segmented: bool = False
    rules: FeedRules | None = None
    date_columns: Sequence[str] | None = None  # explicit list; None = name rule
    order_by: Sequence[str] = field(default_factory=lambda: ("batch_date",))


def cleanse_batch(df: DataFrame, params: FeedParams, batch_date: str) -> DataFrame:
    """Every row-level step up to (not including) the valid/rejected split."""
    rules = params.rules or rules_for_file(params.file_name)
    df = remove_junk_values(df)
    df = fill_cycle_dates(df, batch_date)
    df = normalize_date_columns(df, params.date_columns)
    keys = list(params.primary_keys or [])
    if rules.unique_key:
        df = number_within_key(df, [k for k in keys if k != UNIQUE_KEY_COLUMN], ["transaction_date"], UNIQUE_KEY_COLUMN)
    elif keys:
        # both sides of the flag's join read the rows, so they are cleansed once and written
        df = flag_duplicates(written(df, "raw-cleansed"), keys, list(params.order_by))
    if rules.flag_sma_balance:
        df = flag_invalid_sma_balance(df)
    if rules.flag_plan_ids:
        df = flag_invalid_plan_ids(df)
    if rules.txn_amounts:
        df = parse_txn_amounts(df)
    if rules.default_client:
        df = fill_client_id(df)
    if rules.default_loan_type:
        df = fill_loan_type(df)
    if rules.fund_remap_target:
        df = remap_loan_funds(df, rules.fund_remap_target)
    return df


def staging_to_raw(
    spark: SparkSession,
    staging: DataFrame,
    params: FeedParams,
    batch_date: str,
    raw_base: str,
    audit_path: str | None = None,
    id_changes: DataFrame | None = None,
    database: str | None = None,
    keep_versions: int | None = None,
    bucketed: tuple[str, int] | None = None,
) -> dict[str, str]:
    """Run the job; returns the written locations ({'valid', 'rejected'}).

    ``bucketed`` (a primary key column, a number of buckets) keeps a merged feed
    in hash buckets of the catalog's ``database``, so a load costs the buckets it
    touches; the id changes are part of the same switch, and 'valid' is the
    table's name.

    An incremental, non-history feed has participant-id changes applied to
    the merged table: those in ``id_changes``, else those that
    :func:`ledgerflow.plans.id_rewrite.id_changes_for` finds in ``database``."""
    table_base = f"{raw_base.rstrip('/')}/{params.source_name}/{params.table_name}"
    rejected_path = f"{table_base}_rejected"

    rules = params.rules or rules_for_file(params.file_name)
    keys = list(params.primary_keys or [])
    merged = rules.seqhist or params.file_load == "incremental"
    if merged and not keys:
        raise ValueError(f"{params.table_name}: a merged feed needs primary keys")
    if bucketed and not (merged and database is not None and bucketed[0] in keys):
        raise ValueError(f"{params.table_name}: buckets need a merged feed, a database, and a primary key to hash")

    def changes() -> DataFrame | None:
        if params.file_load != "incremental" or rules.seqhist:
            return None
        if id_changes is None and database is not None:
            return id_changes_for(spark, params.source_name, params.file_name, params.file_load, database)
        return id_changes

    def register(table: str, path: str, parts: list[str] | None = None) -> None:
        if database is not None:
            writers.register_table(spark, f"{database}.{table}", path, writers.read_declared(spark, path).schema, parts)

    batch = staging.where(F.col("batch_date") == batch_date)  # partition filter at the scan

    def job(watch: Callable[[DataFrame], DataFrame] = lambda df: df) -> dict[str, str]:
        flagged = watch(cleanse_batch(batch, params, batch_date)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            out = {}
            if "to_drop" in flagged.columns:
                parts = ["batch_date", "file_segment"] if params.segmented else ["batch_date"]
                rejected = rejected_rows(flagged)
                writers.overwrite(rejected, rejected_path, parts)
                writers.save_schema(spark, rejected_path, rejected.schema)
                register(f"{params.table_name}_rejected", rejected_path, parts)
                out["rejected"] = rejected_path
            valid = valid_rows(flagged)
            if bucketed:
                found, name = changes(), f"{database}.{params.table_name}"
                buckets.create(spark, name, f"{table_base}_buckets", valid.schema, [bucketed[0]], bucketed[1])
                buckets.merge_into_buckets(spark, name, valid, upsert_spec(keys), moves=None if found is None else id_change_rows(found))
                return out | {"valid": name}
            if merged:
                found = changes()
                rewrite = None if found is None else lambda df: rewrite_keys(df, id_change_rows(found))
                # history feeds are merged without deletes, like the others
                out["valid"] = writers.merge_into(spark, table_base, valid, upsert_spec(keys), then=rewrite, keep=keep_versions)
            else:
                out["valid"] = writers.write_version(valid, table_base, keep=keep_versions)
            register(params.table_name, out["valid"])
        finally:
            flagged.unpersist()
        return out

    if audit_path is None:
        return job()
    seen: list[Callable[[], dict[str, int]]] = []

    def watched(df: DataFrame) -> DataFrame:
        df, counts = observe_counts(df)
        seen.append(counts)
        return df

    # the rows are counted where the first write fills the cache
    return writers.run_with_audit(spark, audit_path, lambda: job(watched), source_name=params.source_name, file_name=params.file_name,
                                  batch_date=batch_date, table_name=params.table_name, counts=lambda: seen[0]())

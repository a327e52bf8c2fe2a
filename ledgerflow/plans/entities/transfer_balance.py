"""T5: fund-transfer balance, two channels into one typed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.copies import q

# Source-system label per channel.
LABEL_NG = "VRP-PB"
LABEL_JB = "VRP-SP"


def transfer_channel(feed: DataFrame, label: str) -> DataFrame:
    """One channel's typed projection."""
    cycle = q("source_cycle_date").try_cast("date")
    return feed.select(
        q("client_id"), q("plan_number"), q("participant_id"),
        q("sequence_number").alias("transfer_balance_seq_number"),
        cycle.alias("source_cycle_date"),
        F.lit(label).alias("source_system"),
        F.last_day(cycle).alias("source_month_end_date"),
        q("from_fund_source").alias("from_fund_id"),
        q("to_fund_source").alias("to_fund_id"),
        q("allocation_percent").try_cast("decimal(7,4)").alias("allocation_percent"),
        q("amount").try_cast("decimal(14,2)").alias("transfer_amount"),
        q("activity").alias("activity_type"),
        *[q(f"usage_code_{i}") for i in range(1, 6)],
        q("rev_run_date").try_cast("date").alias("reversal_run_date"),
        q("rev").alias("reversal_type_flag"),
    )


def transfer_balance(jb_feed: DataFrame, ng_feed: DataFrame) -> DataFrame:
    """jb rows then ng rows, bag union by name."""
    return transfer_channel(jb_feed, LABEL_JB).unionByName(transfer_channel(ng_feed, LABEL_NG))

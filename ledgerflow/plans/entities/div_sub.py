"""T4: division / sub-unit with the unallocated flag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.aggregates import allocation_summary, unallocated_flag
from ledgerflow.plans.entities.transfer_balance import LABEL_NG

DIV_SUB_COLUMNS = ("client_id", "plan_number", "div_sub_id", "div_sub_key", "address_city", "address_line_1",
                   "address_line_2", "address_line_3", "address_state", "address_zip_code", "primary_name",
                   "secondary_name", "source_system", "source_cycle_date", "plan_unallocated_flag")


def div_sub(divisions: DataFrame, accounts: DataFrame, details: DataFrame, label: str = LABEL_NG) -> DataFrame:
    """``divisions`` (dpg) LEFT JOIN per (div_sub_id, plan_number) account summary.

    The summary comes from ``accounts RIGHT JOIN details`` on participant
    and plan, keeping details with a non-empty division (D8 strict).  The
    label is a parameter; the default reproduces the reference's (D11).
    """
    op = details.where(F.col("div_sub_id").isNotNull() & (F.col("div_sub_id") != ""))
    sp = accounts.select(F.col("participant_id").alias("_sp_pid"), F.col("plan_number").alias("_sp_plan"),
                         F.col("participant_account_type_code"))
    ptd = op.join(sp, (op["part_number"] == sp["_sp_pid"]) & (op["plan_number"] == sp["_sp_plan"]), "left")
    summary = allocation_summary(ptd, ["div_sub_id", "plan_number"], "participant_account_type_code")
    summary = summary.withColumnsRenamed({"div_sub_id": "_s_div", "plan_number": "_s_plan"})
    j = divisions.join(summary, (divisions["plan_number"] == summary["_s_plan"]) & (divisions["div_sub_id"] == summary["_s_div"]), "left")
    return j.select(
        "client_id", "plan_number", "div_sub_id", F.lit(None).cast("string").alias("div_sub_key"),
        "address_city", "address_line_1", "address_line_2", "address_line_3", "address_state", "address_zip_code",
        "primary_name", "secondary_name", F.lit(label).alias("source_system"), "source_cycle_date",
        unallocated_flag(F.col("_acct_n"), F.col("_acct_min"), F.col("_acct_max"), empty_is_null=True).alias("plan_unallocated_flag"),
    )

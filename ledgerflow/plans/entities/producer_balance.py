"""Producer x participant balances.

The raw layer keeps every column as text, so measures and dates are cast
with ``try_cast`` before use: text that is no number counts as missing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.cleansing import NULL_KEY
from ledgerflow.operators.aggregates import distinct_concat, role_type_code
from ledgerflow.operators.joins import dealt_join, heavy_keys, prefix, sentinel

# Money types and the loan system that reports principal.
MONEY_EE = "EE"
MONEY_ER = "ER"
PRINCIPAL_SYSTEM = "PREMIER"
OUT_DECIMAL = "decimal(17,2)"


def producer_balance(producer: DataFrame, core: DataFrame, loans: DataFrame, life: DataFrame,
                     strict_life_join: bool = True, as_of: dt.date | str | None = None) -> DataFrame:
    """Producers (distinct role strings) INNER core sums, LEFT loan sums, LEFT life sums.

    ``strict_life_join`` joins life balances on plan and participant prefix
    (D6); False reproduces the plan-only join of the reference.
    Core sums group by the defaulted cycle date (D23): the day before
    ``as_of`` (None: today).
    """
    zero = F.lit(0).cast(OUT_DECIMAL)
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")

    def money(c: str | Column) -> Column:
        return (F.col(c) if isinstance(c, str) else c).try_cast(OUT_DECIMAL)

    pr = distinct_concat(
        producer, ["participant_id", "plan_number", "rep_tax_id_ssn"],
        {"producer_role_code": F.col("producer_role_code_desc"),
         "producer_role_type": role_type_code(F.col("producer_role_type"))},
    )
    yesterday = F.date_sub(today, 1)
    m1 = core.select(
        "participant_id", "plan_number",
        F.coalesce(F.col("source_cycle_date").try_cast("date"), yesterday).alias("source_cycle_date"),
        F.coalesce(money("cash_value_amount"), zero).alias("_cash"),
        F.coalesce(money("sdba_cash_value_amount"), zero).alias("_sdba"),
        F.coalesce(money("ytd_contributions"), zero).alias("_ytd"),
        F.when(F.col("money_type_description") == MONEY_EE, money("cash_value_amount")).alias("_ee"),
        F.when(F.col("money_type_description") == MONEY_ER, money("cash_value_amount")).alias("_er"),
    ).groupBy("plan_number", "participant_id", "source_cycle_date").agg(
        F.sum("_cash").alias("core"), F.sum(F.coalesce("_ee", zero)).alias("ee"), F.sum(F.coalesce("_er", zero)).alias("er"),
        F.sum("_ytd").alias("ytd"), F.sum("_sdba").alias("sdba"),
    ).withColumnsRenamed({"plan_number": "m1_plan", "participant_id": "m1_pid", "source_cycle_date": "m1_cycle"})
    m2 = loans.select(
        sentinel(F.col("plan_number")).alias("m2_plan"), sentinel(F.col("participant_id")).alias("m2_pid"),
        F.when(F.col("source_system") == PRINCIPAL_SYSTEM, money("outstanding_principal_balance"))
        .otherwise(money("loan_balance")).alias("_loan"),
    ).groupBy("m2_plan", "m2_pid").agg(F.sum(F.coalesce("_loan", zero)).alias("loan"))
    m3 = life.groupBy("plan_number", "valuation_date", "participant_id").agg(
        F.sum(F.coalesce(money("cash_value_amt"), zero)).alias("life")
    ).withColumnsRenamed({"plan_number": "m3_plan", "participant_id": "m3_pid", "valuation_date": "life_valuation_date"})

    # producers without plan and participant meet in one key: it is found in the feed and dealt over tasks
    m1 = m1.withColumn("m1_prefix", prefix(F.col("m1_pid")))
    on = [("plan_number", "m1_plan"), ("participant_id", "m1_prefix")]
    j = dealt_join(pr, m1, on, "inner", heavy_keys(producer, [a for a, _ in on]))
    j = j.join(m2, (j["m1_plan"] == m2["m2_plan"]) & (prefix(j["m1_pid"]) == prefix(m2["m2_pid"])), "left")
    life_on = sentinel(m3["m3_plan"]) == sentinel(j["m1_plan"])
    if strict_life_join:
        life_on = life_on & (sentinel(prefix(m3["m3_pid"])) == sentinel(prefix(j["m1_pid"])))
    j = j.join(m3, life_on, "left")

    loan = F.coalesce(F.col("loan"), zero)
    life_amt = F.col("life").try_cast(OUT_DECIMAL)
    noncore = loan + F.coalesce(F.col("sdba"), zero) + F.coalesce(F.col("life"), zero)

    def out(c, name):
        return F.coalesce(c, zero).try_cast(OUT_DECIMAL).alias(name)

    return j.select(
        F.coalesce("rep_tax_id_ssn", F.lit(NULL_KEY)).alias("rep_tax_id_ssn"),
        F.coalesce("plan_number", F.lit(NULL_KEY)).alias("plan_number"),
        F.coalesce(prefix(F.col("participant_id")), F.lit(NULL_KEY)).alias("participant_id"),
        "producer_role_code", "producer_role_type",
        out(F.col("core"), "core_cash_value_amount"), out(noncore, "noncore_cash_value_amount"),
        out(F.col("ee"), "ee_cash_value_amount"), out(F.col("er"), "er_cash_value_amount"),
        out(F.col("sdba"), "sdba_cash_value_amount"), out(loan, "loan_cash_value_amount"),
        out(life_amt, "life_cash_value_amount_monthly"), "life_valuation_date",
        out(F.col("ytd"), "ytd_contributions"),
        F.coalesce(F.col("m1_cycle"), yesterday).alias("source_cycle_date"),
    )

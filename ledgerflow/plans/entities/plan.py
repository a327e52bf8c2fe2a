"""Plan entity from six differently shaped sources.

Two external plan feeds (cef, pdab), and per channel a plan extract and a
daily plan feed; each channel's extract and daily rows are merged per key
(J14), then everything is conformed to one 166-column target (O4) and
unioned (O3).  All joins are left outer joins to dimensions; the account
set (A5/A8) and company code (A7) are per-plan aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.cleansing import NULL_KEY
from ledgerflow.operators.aggregates import allocation_summary, first_code
from ledgerflow.operators.conform import conform
from ledgerflow.operators.joins import merge_frames, sentinel
from ledgerflow.plans.entities.transfer_balance import LABEL_JB, LABEL_NG

# The conformed plan columns and their types, in order.
PLAN_TARGET_SPEC = """
    client_id:string plan_number:string plan_system_key:string source_system:string
    plan_address_line_1:string plan_address_line_2:string plan_address_line_3:string plan_address_state:string
    plan_address_city:string plan_address_zip_code:string plan_company_code:string plan_manager_name:string
    plan_name_line_1:string irc_code:string irc_code_desc:string plan_product_code:string
    plan_product_short_name:string plan_unallocated_flag:string tpa_code:string tpa_name:string
    plan_issue_date:date plan_expand_flag:string plan_end_mmdd:string loans_allowed_flag:string
    number_loans_allowed:int voya_send_notices_flag:string hardship_suspension:string sdbo_status:string
    employer_stock:string crm_name:string crm_email:string crm_phone:string
    trustee_name:string trustee_email:string trustee_phone:string ach_online_payment_flag:string
    advice_part_elig_allowed:string admin_system:string dwe_status:string ein_number:int
    ein_suffix:string enh_send_notice_flag:string alternate_acct_number_ind:string financial_engine_fees_ind:string
    grp_plan_indicator:string grp_product_name:string initial_notification_srvc_ind:string loan_401k_elective_limit:int
    loan_maximum_amount:decimal(11,2) loan_max_pct_vested_curr_val:decimal(3,2) loan_minimum_amount:decimal(11,2) managed_account_end_date:date
    managed_account_fee:string managed_account_service_ind:string managed_account_start_date:date max_deferral_amount:decimal(11,2)
    max_deferral_percent:decimal(5,4) model_portfolio_fix_acct_flag:string model_portfolio_fix_acct_name:string model_portfolio_qdia_model_num:string
    model_portf_qdia_tgt_date_ind:string money_out_service_model:string permissible_withdrawal_ind:string plan_name_line_2:string
    ma_ama_ria_firm_name:string asset_alloc_made_easy_is_qdia:string grp_product_desc:string proposal_mail_date:date
    qdia_default_fund_iv:string qdia_default_fund_number:string qdia_effective_date:date qdia_indicator:string
    qdia_option:string auto_enroll_eaca_qaca_ind:string qdia_portfolio_type_fund_name:string auto_enroll:string
    billing_group:string source_processing_date:date crc_type:string dac_override_amount:decimal(15,2)
    end_date:date erisa_flag:string exchange_indicator:string fee_deduction_method:string
    fiduciary_service_flag:string fiduciary_services_program:string financial_advisor:string fund_menu:string
    income_secure_ma_flag:string is_free_look_recurring:string ma_cust_adv_pgv:string ma_init_freelook_start_date:date
    ma_init_freelook_start_durn:string ma_init_freelook_start_window:string ma_promo_freelook_start_date:date ma_promo_freelook_start_durn:string
    ma_promo_freelook_start_window:string ma1_override_amount:decimal(8,6) ma2_override_amount:decimal(5,2) mai_override_amount:decimal(6,2)
    mam_override_amount:decimal(5,2) managed_account_default_salary:decimal(15,2) managed_account_fee_type:string managed_account_flag:string
    managed_accounts_program:string ma_program_adoption_type:string ma_program_default:string ma_program_pricing_model:string
    market_code:string migration_indicator:string mtf_fee_recovery:string mtf_override_amout:decimal(10,2)
    old_billing_group:string old_fixed_fund_number:string old_product_code:string open_arch_menu_type:string
    pcf_fee_recovery:string pcf_override_amount:decimal(8,2) plan_reference_key:string portfolio_blueprint_tier_amt:string
    ppf_fee_recovery:string ppf_override_amount:decimal(8,2) primary_contact_email:string primary_contact_first_name:string
    primary_contact_last_name:string primary_contact_phone_no:string primary_contact_source_system:string qdia_portfolio_fund_series:string
    rep_id:string roth_ind:string safe_harbor_amount:string safe_harbor_percent:string
    sponsor_address1:string sponsor_address2:string sponsor_address3:string sponsor_city:string
    sponsor_country:string sponsor_name_line_1:string sponsor_zip_code:string source_cycle_date:date
    uses_contrib_rate_escalator:string uses_eligibility_module:string uses_loan_sweep_module:string vesting_data_source:string
    sponsor_state:string sponsor_name_line_2:string ss_plan_sept_act_code:string start_date:date
    superior_plan_name:string superior_plan_reference_key:string ein_full:string usb_pgm_flag:string
    ma_voya_as_advisor_is_qdia:string wealth_management_end_date:date wealth_mgmt_retirement_allowed:string wealth_management_start_date:date
    fid_ser_end_date:date fid_ser_fee_ded_meth:string fid_ser_fund_menu:string fid_ser_program_name:string
    fid_ser_start_date:date product_type:string market_indicator:string underlying_source_system:string
    plan_administrator_name:string ease_db_plan_id:string
"""
PLAN_TARGET = tuple(tuple(tok.split(":", 1)) for tok in PLAN_TARGET_SPEC.split())
RECORD_KEEPING_COLUMN = "record_Keeping_group_ind"
PLAN_COLUMNS = tuple(n for n, _ in PLAN_TARGET) + (RECORD_KEEPING_COLUMN,)

# Plans of the record-keeping group (ng extract and ng daily plan).
RECORD_KEEPING_PLANS = ("666896", "666897", "666898", "666899", "666984", "666985", "666986", "666987", "666988",
                        "666989", "666990", "666991", "666992", "666993", "666994", "666995", "666996", "666997",
                        "666998")
# Helper-table rows that apply to plans.
HELPER_SOURCE = "CASE PROF"
PAYOUT_PRODUCT = "PAYOUT"
CONTACT_COLUMNS = ("crm_name", "crm_email", "crm_phone", "trustee_name", "trustee_email", "trustee_phone")

# Source column -> target column, external feed A (cef).
CEF_RENAMES = {
    "plan_client_id": "client_id", "plan_sys_key": "plan_system_key", "plan_src_system": "source_system",
    "plan_comp_code": "plan_company_code", "plan_manager": "plan_manager_name", "plan_name": "plan_name_line_1",
    "plan_irc_code": "irc_code", "plan_irc_code_text": "irc_code_desc", "plan_product_shrt_name": "plan_product_short_name",
    "plan_allocated_flag": "plan_unallocated_flag", "plan_tpa_code": "tpa_code", "plan_tpa_full_name": "tpa_name",
    "plan_year_end": "plan_end_mmdd", "loans_allowed": "loans_allowed_flag", "ing_send_notices": "voya_send_notices_flag",
    "plan_spon_addr_line_01": "sponsor_address1", "plan_spon_addr_line_02": "sponsor_address2",
    "plan_spon_addr_line_03": "sponsor_address3", "plan_spon_addr_city": "sponsor_city",
    "plan_spon_addr_country": "sponsor_country", "plan_spon_addr_zip": "sponsor_zip_code",
    "plan_spon_addr_state": "sponsor_state",
}
CEF_SAME = ("plan_number", "plan_product_code", "plan_issue_date", "plan_expand_flag", "number_loans_allowed",
            "hardship_suspension", "sdbo_status", "employer_stock")
# Source column -> target column, external feed B (pdab).
PDAB_RENAMES = {
    "plan_source_system": "source_system", "plan_name": "plan_name_line_1", "plan_spon_add_line1": "sponsor_address1",
    "plan_spon_add_line2": "sponsor_address2", "plan_spon_add_line3": "sponsor_address3", "plan_spon_city": "sponsor_city",
    "plan_spon_country": "sponsor_country", "plan_spon_zip_code": "sponsor_zip_code", "plan_spon_state": "sponsor_state",
}
PDAB_SAME = ("plan_number", "plan_system_key", "plan_company_code", "plan_issue_date")
# Source column -> target column, plan extracts.
EXTRACT_RENAMES = {
    "loan_maximum_percent_of_vested_current_value": "loan_max_pct_vested_curr_val",
    "model_portfolio_fixed_account_flag": "model_portfolio_fix_acct_flag",
    "model_portfolio_fixed_account_name": "model_portfolio_fix_acct_name",
    "model_portfolio_qdia_model_number": "model_portfolio_qdia_model_num",
    "mp_qdia_model_type_ind": "model_portf_qdia_tgt_date_ind", "loan_eligibility": "loans_allowed_flag",
}
EXTRACT_SAME = ("plan_number", "ach_online_payment_flag", "advice_part_elig_allowed", "ein_number", "ein_suffix",
                "grp_plan_indicator", "grp_product_name", "loan_401k_elective_limit", "loan_maximum_amount",
                "loan_minimum_amount", "max_deferral_amount", "max_deferral_percent", "plan_administrator_name",
                "proposal_mail_date", "qdia_effective_date", "qdia_option", "ease_db_plan_id", "financial_engine_fees_ind",
                "irc_code", "plan_address_line_1", "plan_address_line_2", "plan_address_line_3")
# Source column -> target column, daily plan feeds.
DAILY_RENAMES = {
    "planreferencekey": "plan_reference_key", "ss_plan_sep_acct_code": "ss_plan_sept_act_code",
    "sponsor_full_name": "sponsor_name_line_1", "portfolio_blueprint_tier_amount": "portfolio_blueprint_tier_amt",
    "pcf_fee_recovery_": "pcf_fee_recovery", "wealth_management_for_retirement_allowed": "wealth_mgmt_retirement_allowed",
    "managed_accounts_program_default_": "ma_program_default",
    "managed_accounts_program_adoption_type": "ma_program_adoption_type",
    "managed_accounts_program_pricing_model": "ma_program_pricing_model",
    "ma_init_freelook_start_duration": "ma_init_freelook_start_durn",
    "ma_promotional_free_look_start_date": "ma_promo_freelook_start_date",
    "ma_promotional_free_look_start_window": "ma_promo_freelook_start_window",
    "ma_promotional_free_look_start_duration": "ma_promo_freelook_start_durn",
    "is_free_look_re_occurring": "is_free_look_recurring", "ama_ria_firm_name": "ma_ama_ria_firm_name",
    "plan_offers_income_secure_for_managed_accounts": "income_secure_ma_flag",
    "asset_allocation_made_easier_is_qdia": "asset_alloc_made_easy_is_qdia",
    "voya_as_advisor_is_qdia": "ma_voya_as_advisor_is_qdia", "ubs_program_flag": "usb_pgm_flag",
    "ubs_financial_advisor": "financial_advisor", "ubs_plan_rep_id": "rep_id", "ma_cust_adv_pgm": "ma_cust_adv_pgv",
    "feed_alternate_account_number_ind": "alternate_acct_number_ind",
    "initial_notification_service_ind": "initial_notification_srvc_ind", "ing_send_notice_flag": "voya_send_notices_flag",
    "product_code": "plan_product_code",
}
# Daily target columns filled by the daily feed under their own name.
DAILY_SAME = (
    "plan_number", "superior_plan_reference_key", "superior_plan_name", "admin_system", "plan_name_line_1",
    "billing_group", "erisa_flag", "managed_account_flag", "fiduciary_service_flag", "roth_ind",
    "auto_enroll_eaca_qaca_ind", "sdbo_status", "safe_harbor_percent", "safe_harbor_amount", "plan_manager_name",
    "market_code", "mam_override_amount", "mai_override_amount", "ma1_override_amount", "ma2_override_amount",
    "primary_contact_first_name", "primary_contact_last_name", "primary_contact_email", "primary_contact_phone_no",
    "primary_contact_source_system", "auto_enroll", "crc_type", "qdia_portfolio_fund_series", "exchange_indicator",
    "migration_indicator", "old_product_code", "old_fixed_fund_number", "old_billing_group",
    "fiduciary_services_program", "start_date", "end_date", "fund_menu", "fee_deduction_method", "mtf_override_amout",
    "mtf_fee_recovery", "pcf_override_amount", "ppf_override_amount", "ppf_fee_recovery", "dac_override_amount",
    "wealth_management_start_date", "wealth_management_end_date", "open_arch_menu_type", "managed_account_end_date",
    "managed_account_start_date", "fid_ser_program_name", "fid_ser_start_date", "fid_ser_end_date",
    "fid_ser_fund_menu", "fid_ser_fee_ded_meth", "managed_accounts_program", "managed_account_fee_type",
    "ma_init_freelook_start_date", "ma_init_freelook_start_window", "managed_account_default_salary", "dwe_status",
    "enh_send_notice_flag", "hardship_suspension", "managed_account_fee", "managed_account_service_ind",
    "money_out_service_model", "permissible_withdrawal_ind", "number_loans_allowed", "plan_name_line_2",
    "qdia_default_fund_iv", "qdia_default_fund_number", "qdia_portfolio_type_fund_name", "plan_issue_date",
    "plan_end_mmdd",
)


def _mapped(df: DataFrame, renames: Mapping[str, str], same: Sequence[str]) -> dict[str, str]:
    """Target expressions (SQL text) of the mapped source columns; a feed that lacks one is an error."""
    missing = [c for c in (*renames, *same) if c not in df.columns]
    if missing:
        raise ValueError(f"the plan feed lacks mapped columns: {', '.join(missing)}")
    return {t: f"`{s}`" for s, t in renames.items()} | {c: f"`{c}`" for c in same}


def _contacts_join(base: DataFrame, contacts: DataFrame, plan_col: str = "plan_number") -> DataFrame:
    dt = contacts.select(F.col("plan_id").alias("_dt_plan"), *CONTACT_COLUMNS)
    return base.join(dt, sentinel(base[plan_col]) == sentinel(dt["_dt_plan"]), "left").drop("_dt_plan")


def _record_keeping(df: DataFrame, flagged: bool) -> DataFrame:
    plans = ", ".join(f"'{p}'" for p in RECORD_KEEPING_PLANS)
    value = f"CASE WHEN plan_number IN ({plans}) THEN 'Y' END" if flagged else "CAST(NULL AS string)"
    return df.withColumn(RECORD_KEEPING_COLUMN, F.expr(value))


def plan_cef(feed: DataFrame, contacts: DataFrame) -> DataFrame:
    """Branch cef: external plan feed A + contacts."""
    j = _contacts_join(feed, contacts)
    exprs = _mapped(j, CEF_RENAMES, CEF_SAME)
    exprs.update({c: f"`{c}`" for c in CONTACT_COLUMNS})
    exprs["grp_product_desc"] = f"'{PAYOUT_PRODUCT}'"
    exprs["underlying_source_system"] = "plan_src_system"
    return _record_keeping(conform(j, PLAN_TARGET, exprs, passthrough=False), False)


def plan_pdab(feed: DataFrame, contacts: DataFrame) -> DataFrame:
    """Branch pdab: external plan feed B + contacts."""
    j = _contacts_join(feed, contacts)
    exprs = _mapped(j, PDAB_RENAMES, PDAB_SAME)
    exprs.update({c: f"`{c}`" for c in CONTACT_COLUMNS})
    exprs["client_id"] = f"coalesce(client_id, '{NULL_KEY}')"
    exprs["underlying_source_system"] = "plan_source_system"
    return _record_keeping(conform(j, PLAN_TARGET, exprs, passthrough=False), False)


def _plan_aggregates(dims: Mapping[str, DataFrame], accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    company = first_code(dims["producer_roles"], "plan_id", "role_key", "_company_code")
    acct = allocation_summary(accounts.where(F.col("plan_number").isNotNull() & (F.col("plan_number") != "")),
                              ["plan_number"], "participant_account_type_code").withColumnRenamed("plan_number", "_acct_plan")
    return company, acct


def _common_dims(pld: DataFrame, dims: Mapping[str, DataFrame], accounts: DataFrame) -> DataFrame:
    """TPA map, contacts, company code (A7) and account summary (A5) joined to a plan frame."""
    tp = dims["tpa_map"].select(F.col("plan_code").alias("_tp_plan"), F.col("tpa_code").alias("_tpa_code"))
    j = pld.join(tp, pld["plan_number"] == tp["_tp_plan"], "left").drop("_tp_plan")
    j = _contacts_join(j, dims["contacts"])
    company, acct = _plan_aggregates(dims, accounts)
    j = j.join(company, sentinel(j["plan_number"]) == sentinel(company["plan_id"]), "left").drop("plan_id")
    return j.join(acct, j["plan_number"] == acct["_acct_plan"], "left").drop("_acct_plan")


def _shared_exprs(label: str) -> dict[str, str]:
    return {
        "client_id": f"coalesce(nullif(trim(client_id), ''), '{NULL_KEY}')",
        "source_system": f"'{label}'",
        "plan_unallocated_flag": "CASE WHEN _acct_min = 'ALLOC' AND _acct_max = 'ALLOC' THEN 'N' ELSE 'Y' END",
        "plan_company_code": "_company_code",
        "tpa_code": "_tpa_code",
        "underlying_source_system": f"CASE WHEN client_id = 'NG' THEN '{LABEL_NG}' ELSE '{LABEL_JB}' END",
        "source_cycle_date": "CASE WHEN source_cycle_date > '9999-12-31' THEN NULL ELSE try_cast(source_cycle_date AS date) END",
        **{c: f"`{c}`" for c in CONTACT_COLUMNS},
    }


def plan_extract(pld: DataFrame, dims: Mapping[str, DataFrame], accounts: DataFrame, channel: str,
                 address_from_extract: bool = False) -> DataFrame:
    """Branches ext_jb / ext_ng: plan extract + TPA map/names, contacts, role
    helper on the IRC code, company code and account set.
    ``address_from_extract`` maps the extract's state/city/zip (T3)."""
    j = _common_dims(pld, dims, accounts)
    names = dims["tpa_names"].select(F.col("tpa_code").alias("_n_tpa"), F.col("name").alias("_tpa_name"))
    j = j.join(names, j["_tpa_code"] == names["_n_tpa"], "left").drop("_n_tpa")
    helper = dims["role_helper"].where(F.col("source_system_nm") == HELPER_SOURCE).select(
        F.col("source_system_field_value").alias("_irc_value"), F.col("source_system_field_value_txt").alias("_irc_desc"))
    j = j.join(helper, j["irc_code"] == helper["_irc_value"], "left").drop("_irc_value")
    exprs = _mapped(j, EXTRACT_RENAMES, EXTRACT_SAME)
    exprs.update(_shared_exprs(LABEL_NG if channel == "ng" else LABEL_JB))
    exprs["ein_full"] = "concat(ein_number, ein_suffix)"
    exprs["irc_code_desc"] = "_irc_desc"
    exprs["tpa_name"] = "trim(_tpa_name)"
    if channel == "ng":
        exprs["sponsor_name_line_1"] = "plan_name_line_1"
    else:
        exprs["grp_product_desc"] = "product_description"
    if address_from_extract:
        exprs.update({"plan_address_state": "state", "plan_address_city": "city", "plan_address_zip_code": "zip"})
    return _record_keeping(conform(j, PLAN_TARGET, exprs, passthrough=False), channel == "ng")


def plan_daily(pld: DataFrame, dims: Mapping[str, DataFrame], accounts: DataFrame, channel: str) -> DataFrame:
    """Branches plan_ng / plan_jb: daily plan feed + TPA map, sponsor country,
    service info (plan and client), contacts, product helper (ng), company
    code and account set.  The jb branch's role-helper join selects no
    column and could only multiply rows, so it is left out (D31)."""
    j = _common_dims(pld, dims, accounts)
    pres = dims["sponsor_country"].select(F.col("plan_number").alias("_pres_plan"), F.col("sponsor_country").alias("_country"))
    j = j.join(pres, j["plan_number"] == pres["_pres_plan"], "left").drop("_pres_plan")
    sit_cols = ("uses_eligibility_module", "uses_loan_sweep_module", "vesting_data_source", "uses_contribution_rate_escalator",
                "so_product_information_prod_tp", "so_plan_service_info_mkt_ind")
    sit = dims["service_info"].select(F.col("plan_id").alias("_sit_plan"), F.col("client_id").alias("_sit_client"),
                                      *[F.col(c).alias(f"_sit_{c}") for c in sit_cols])
    j = j.join(sit, (j["plan_number"] == sit["_sit_plan"]) & (j["client_id"] == sit["_sit_client"]), "left")
    if channel == "ng":
        ph = dims["product_helper"].where(F.col("source_system_name") == HELPER_SOURCE).select(
            F.col("source_system_code_value").alias("_ph_code"), F.col("specification_nm").alias("_spec"))
        j = j.join(ph, j["product_code"] == ph["_ph_code"], "left")
    zip9 = "substring(plan_address_zip_code, 1, 9)"
    exprs = _mapped(j, DAILY_RENAMES, DAILY_SAME)
    exprs.update(_shared_exprs(LABEL_NG if channel == "ng" else LABEL_JB))
    exprs.update({
        "sponsor_address1": "plan_address_line_1", "sponsor_address2": "plan_address_line_2",
        "sponsor_address3": "plan_address_line_3", "sponsor_city": "plan_address_city",
        "sponsor_state": "plan_address_state", "sponsor_zip_code": zip9,
        "plan_address_state": "plan_address_state", "plan_address_city": "plan_address_city",
        "plan_address_zip_code": zip9, "sponsor_country": "_country",
        "qdia_indicator": "substring(trim(qdia_indicator), 1, 1)",
        "uses_contrib_rate_escalator": "_sit_uses_contribution_rate_escalator",
        "uses_eligibility_module": "_sit_uses_eligibility_module",
        "uses_loan_sweep_module": "_sit_uses_loan_sweep_module",
        "vesting_data_source": "_sit_vesting_data_source",
        "product_type": "_sit_so_product_information_prod_tp",
        "market_indicator": "_sit_so_plan_service_info_mkt_ind",
    })
    if channel == "ng":
        exprs["grp_product_desc"] = "_spec"
    return _record_keeping(conform(j, PLAN_TARGET, exprs, passthrough=False), channel == "ng")


def plan(cef: DataFrame, pdab: DataFrame, extracts: Mapping[str, DataFrame], daily: Mapping[str, DataFrame],
         accounts: Mapping[str, DataFrame], dims: Mapping[str, DataFrame], keys: Sequence[str] = ("plan_number",)) -> DataFrame:
    """T2.  ``extracts``/``daily``/``accounts`` are keyed by channel ('ng', 'jb');
    ``dims``: tpa_map, tpa_names, contacts, role_helper, product_helper,
    producer_roles, sponsor_country, service_info.  Each channel's extract
    and daily rows are merged per ``keys`` with the extract preferred."""
    parts = [plan_cef(cef, dims["contacts"]), plan_pdab(pdab, dims["contacts"])]
    for ch in ("ng", "jb"):
        ext = plan_extract(extracts[ch], dims, accounts[ch], ch)
        day = plan_daily(daily[ch], dims, accounts[ch], ch)
        parts.append(merge_frames(ext, day, list(keys)).select(*PLAN_COLUMNS))
    return reduce(lambda a, b: a.unionByName(b), parts)


def plan_allocated(pld: DataFrame, dims: Mapping[str, DataFrame], accounts: DataFrame) -> DataFrame:
    """The repaired single jb extract branch (qualified plan number; plan
    address state, city and zip taken from the extract)."""
    return plan_extract(pld, dims, accounts, "jb", address_from_extract=True).drop(RECORD_KEEPING_COLUMN)

"""Feed derivations over the supplied tables.

Written in the SQL subset Spark and DuckDB share (``||``, ``lpad``,
``substring`` from 1, ``cast``, ``CASE``, ``year``/``month``/``day``) so
the Spark query and its oracle start from identical rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, TimestampNTZType, TimestampType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A supplied table.  ``spread`` deals the rows out over the shuffle
    partitions first: the test tables are single-row-group files, which one
    task reads, and some bindings do heavy per-row work on them.  It is off
    unless a binding asks for it, and does not look at sizes."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))) if spread else df


def _tables_in(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def spark_sql(spark: SparkSession, sf_dir: str, sql: str, spread: bool = False) -> DataFrame:
    """Run a feed template on Spark, binding ``{table}`` to the parquet scans."""
    return spark.sql(sql, **{t: table(spark, sf_dir, t, spread) for t in _tables_in(sql)})


def duck_sql(sql: str) -> str:
    """The same template for DuckDB, where the tables are registered views."""
    return sql.format(**{t: t for t in _tables_in(sql)})


def for_compare(df: DataFrame) -> DataFrame:
    """Render types whose Python form differs between engines: dates as ISO
    text, timestamps as ``yyyy-MM-dd HH:mm:ss``, decimals as doubles."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ints_as_double(df: DataFrame) -> DataFrame:
    """Nullable 32-bit integer columns as doubles, so a NULL compares the same
    way in both engines' pandas form (NaN) instead of float-vs-nullable-int."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, IntegerType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def iso(expr: str) -> str:
    """SQL: date of a timestamp as ``yyyy-MM-dd`` text."""
    return f"cast(cast({expr} AS date) AS string)"


def ymd(expr: str) -> str:
    """SQL: date of a timestamp as ``yyyyMMdd`` text."""
    return f"replace({iso(expr)}, '-', '')"


def transfer_feed(where: str) -> str:
    return f"""
SELECT CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'NG' ELSE 'JB' END AS client_id,
       lpad(cast(o_custkey AS string), 6, '0') AS plan_number,
       lpad(cast(o_orderkey AS string), 9, '0') AS participant_id,
       cast(o_orderkey AS string) AS sequence_number,
       {iso('o_orderdate')} AS source_cycle_date,
       o_orderstatus AS from_fund_source,
       substring(o_orderpriority, 1, 1) AS to_fund_source,
       cast(o_custkey % 1000 AS string) || '.' || lpad(cast(o_orderkey % 10000 AS string), 4, '0') AS allocation_percent,
       cast(cast(o_totalprice AS decimal(15,2)) AS string) AS amount,
       substring(o_orderpriority, 3, 20) AS activity,
       substring(o_orderpriority, 1, 1) AS usage_code_1,
       o_orderstatus AS usage_code_2,
       CASE WHEN o_totalprice > 200000 THEN 'H' END AS usage_code_3,
       cast(NULL AS string) AS usage_code_4,
       cast(NULL AS string) AS usage_code_5,
       CASE WHEN o_orderstatus = 'F' THEN cast(cast(o_orderdate AS date) + 30 AS string) END AS rev_run_date,
       CASE WHEN o_orderstatus = 'F' THEN 'R' END AS rev
FROM {{orders}} WHERE {where}"""


# Order date rendered in one of twelve layouts (or a zero-date sentinel),
# chosen by the order key.
def _date_render(d: str, k: str) -> str:
    y = f"cast(year({d}) AS string)"
    m = f"lpad(cast(month({d}) AS string), 2, '0')"
    dd = f"lpad(cast(day({d}) AS string), 2, '0')"
    return f"""CASE {k} % 13
         WHEN 0 THEN {y} || '-' || {m} || '-' || {dd}
         WHEN 1 THEN {y} || '.' || {m} || '.' || {dd}
         WHEN 2 THEN {y} || '/' || {m} || '/' || {dd}
         WHEN 3 THEN {m} || '-' || {dd} || '-' || {y}
         WHEN 4 THEN {m} || '.' || {dd} || '.' || {y}
         WHEN 5 THEN {m} || '/' || {dd} || '/' || {y}
         WHEN 6 THEN {dd} || '-' || {m} || '-' || {y}
         WHEN 7 THEN {dd} || '.' || {m} || '.' || {y}
         WHEN 8 THEN {dd} || '/' || {m} || '/' || {y}
         WHEN 9 THEN {y} || '-' || {m} || '-' || {dd} || ' 10:11:12'
         WHEN 10 THEN {y} || '-' || {m} || '-' || {dd} || 'T23:30:00.000-0500'
         WHEN 11 THEN {y} || {m} || {dd}
         ELSE '00/00/0000' END"""


DATES_FEED = f"""
SELECT o_orderkey,
       {ymd('o_orderdate')} AS batch_date,
       {_date_render('cast(o_orderdate AS date)', 'o_orderkey')} AS order_date,
       CASE WHEN o_orderstatus = 'P' THEN '' ELSE {ymd('o_orderdate')} END AS promise_dt,
       o_orderpriority
FROM {{orders}}"""

CYCLE_FEED = f"""
SELECT event_id, user_id, event_type,
       CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE {iso('ts')} END AS source_cycle_date,
       CASE WHEN event_type = 'view' THEN NULL ELSE {iso('ts')} END AS run_date,
       CASE WHEN event_type = 'click' THEN NULL ELSE {iso('ts')} END AS other_date
FROM {{events}}"""

CUTOFF_FEED = f"""
SELECT event_id, user_id, event_type,
       CASE WHEN event_type = 'error' THEN substring({iso('ts')}, 1, 7) ELSE {iso('ts')} END AS source_cycle_date
FROM {{events}}"""

DEFAULTS_FEED = """
SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN '' WHEN 'MACHINERY' THEN NULL ELSE substring(c_mktsegment, 1, 1) END AS rev_code,
       CASE WHEN c_nationkey < 5 THEN '' WHEN c_nationkey < 10 THEN NULL ELSE 'JB' END AS client_id,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN '' ELSE 'L' END AS loan_type_id
FROM {customer}"""

FUNDS_FEED = """
SELECT p_partkey, cast(p_partkey % 100 AS string) AS fund_iv, p_brand AS fund_code, p_type AS price_id,
       substring(p_brand, 7, 2) AS beneficiary_type
FROM {part}"""

_OVERPUNCH = "'pqrstuvwxy'"


def overpunch_sql(value: str, scale: int, width: int, negative: str) -> str:
    """SQL: encode ``value`` as ``width`` digits with ``scale`` implied decimals,
    the last digit replaced by p..y when ``negative`` holds."""
    digits = f"lpad(cast(cast(round(abs({value}) * {10 ** scale}) AS bigint) AS string), {width}, '0')"
    last = f"substring({_OVERPUNCH}, cast(substring({digits}, {width}, 1) AS integer) + 1, 1)"
    return f"CASE WHEN {negative} THEN substring({digits}, 1, {width - 1}) || {last} ELSE {digits} END"


OVERPUNCH_FEED = f"""
SELECT c_custkey, c_acctbal, {overpunch_sql('c_acctbal', 2, 13, 'c_acctbal < 0')} AS cash FROM {{customer}}"""

TXN_AMOUNTS_FEED = f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus,
       {overpunch_sql('l_extendedprice', 2, 13, "l_returnflag = 'R'")} AS cash,
       {overpunch_sql('l_quantity', 4, 13, "l_linestatus = 'F'")} AS shares,
       {overpunch_sql('l_discount', 6, 13, "l_returnflag = 'A'")} AS share_price,
       {overpunch_sql('l_tax', 6, 11, "l_returnflag = 'N'")} AS xr_rate,
       CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN NULL ELSE cast(l_linenumber AS string) END AS rev_code
FROM {{lineitem}}"""

LINEITEM_FEED = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
       {ymd('l_shipdate')} AS batch_date
FROM {{lineitem}}"""

PLAN_FLAGS_FEED = """
SELECT o_orderkey, CASE o_orderkey % 40 WHEN 0 THEN '999999' WHEN 1 THEN '999998' WHEN 2 THEN '999997' WHEN 3 THEN NULL
            ELSE lpad(cast(o_custkey AS string), 6, '0') END AS plan_number,
       CASE WHEN o_orderstatus = 'F' THEN 'NG' ELSE 'JB' END AS client_id, o_orderpriority
FROM {orders}"""

SMA_FEED = """
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE replace(p_name, ' ', '') END AS sma_fund_balance, p_type
FROM {part}"""

EVENTS_FEED = f"""
SELECT event_id, user_id, event_type, ts AS transaction_date, value, {ymd('ts')} AS batch_date,
       {iso('ts')} AS source_cycle_date
FROM {{events}}"""

RULE_TXN_FEED = """
SELECT l_orderkey, l_linenumber,
       lpad(cast(l_suppkey % 1000 AS string), 3, '0') AS base_transaction_code,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_linenumber AS string) END AS activity_type,
       CASE WHEN l_returnflag = 'R' AND l_linenumber < 6 THEN cast(l_linenumber AS string) END AS usage_code_1,
       CASE WHEN l_returnflag = 'A' THEN l_linestatus END AS usage_code_2,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN cast(8 + l_linenumber % 2 AS string) END AS usage_code_3,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN CASE WHEN l_linenumber < 3 THEN 'WR' ELSE 'X' END END AS usage_code_4,
       CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN '9' END AS usage_code_5,
       CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'R' END AS standard_usage_code_4
FROM {lineitem}"""

TYPES_FEED = """
SELECT CASE WHEN p_type = 'ECONOMY' THEN cast(p_size % 6 AS string) END AS usage_code_1,
       CASE WHEN p_type = 'SMALL' THEN 'O' END AS usage_code_2,
       CASE WHEN p_type = 'MEDIUM' THEN cast(8 + p_size % 2 AS string) END AS usage_code_3,
       CASE WHEN p_type = 'LARGE' THEN CASE WHEN p_size % 2 = 0 THEN 'WR' ELSE 'X' END END AS usage_code_4,
       CASE WHEN p_type = 'STANDARD' AND p_size % 3 = 0 THEN '9' END AS usage_code_5,
       cast(NULL AS string) AS standard_usage_code_1, cast(NULL AS string) AS standard_usage_code_2,
       cast(NULL AS string) AS standard_usage_code_3,
       CASE WHEN p_type = 'PROMO' THEN 'R' END AS standard_usage_code_4,
       cast(NULL AS string) AS standard_usage_code_5,
       p_type AS category, p_brand AS activity,
       lpad(cast(p_partkey % 100 AS string), 3, '0') AS base_transaction_code,
       CASE WHEN p_size % 7 = 0 THEN NULL ELSE cast(p_size % 7 AS string) END AS activity_type,
       CASE WHEN p_retailprice > 990 THEN 'N' ELSE 'Y' END AS process_flag,
       p_name AS activity_code_description
FROM {part}"""


# ---- transaction entity inputs ---------------------------------------------
TXN_RAW_COLUMNS = (
    "participant_id", "plan_number", "base_transaction_code", "activity_type", "rev_code", "run_time", "trade_date",
    "sequence_number", "run_date", "posting_process_counter", "alternate_posting_process_counter",
    "associated_activity", "cash", "margin_code", "other_cash", "pay_period_end_date", "previous_activity_date",
    "reserved_cash_shares_ind", "reversal_reason", "reverse_run_date", "money_source", "share_cost", "share_price",
    "shares", "fund_id", "standard_usage_code_1", "standard_usage_code_2", "standard_usage_code_3",
    "standard_usage_code_4", "standard_usage_code_5", "sub_activity", "trade_type", "uninvested_cash",
    "usage_code_1", "usage_code_2", "usage_code_3", "usage_code_4", "usage_code_5", "use_plan_year_flag",
    "voucher_number", "record_type", "rec_type", "plan_sequence", "pend_stat", "currency_value", "currency_code",
    "xr_type", "xr_rate", "net_currency_value", "rec_code", "plan_num", "fileid_name", "fileid_ext",
    "fileid_ptr_indic", "tran_code", "part_num", "part_num_x", "part_sub_plan", "part_ext1", "fund_src", "etin_num",
    "tran_seq", "separate_acct", "company_code", "share_class", "seq_oper_code", "part_ext", "batch_date",
)

_dec = "cast(cast({} AS decimal(15,2)) AS string)"
TXN_RAW_EXPR = {
    "participant_id": "lpad(cast(l_orderkey AS string), 9, '0')",
    "plan_number": "lpad(cast(l_suppkey AS string), 6, '0')",
    "base_transaction_code": "lpad(cast(l_suppkey % 1000 AS string), 3, '0')",
    "activity_type": "CASE WHEN l_linenumber = 7 THEN NULL ELSE cast(l_linenumber AS string) END",
    "usage_code_1": "CASE WHEN l_returnflag = 'R' AND l_linenumber < 6 THEN cast(l_linenumber AS string) END",
    "usage_code_2": "CASE WHEN l_returnflag = 'A' THEN l_linestatus END",
    "usage_code_3": "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN cast(8 + l_linenumber % 2 AS string) END",
    "usage_code_4": "CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN CASE WHEN l_linenumber < 3 THEN 'WR' ELSE 'X' END END",
    "usage_code_5": "CASE WHEN l_returnflag = 'R' AND l_linenumber >= 6 THEN '9' END",
    "standard_usage_code_4": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'R' END",
    "rev_code": "CASE WHEN l_linenumber = 1 THEN '' ELSE l_returnflag END",
    "run_time": "lpad(cast(l_partkey % 2400 AS string), 4, '0')",
    "trade_date": iso("l_shipdate"),
    "sequence_number": "cast(l_linenumber AS string)",
    "run_date": iso("l_shipdate"),
    "posting_process_counter": "cast(l_partkey AS string)",
    "alternate_posting_process_counter": "cast(l_partkey % 7 AS string)",
    "associated_activity": "CASE WHEN l_linenumber = 3 THEN 'x' ELSE cast(l_linenumber AS string) END",
    "cash": _dec.format("l_extendedprice"),
    "other_cash": "cast(cast(cast(l_extendedprice AS decimal(15,2)) * cast(l_discount AS decimal(15,2)) AS decimal(15,2)) AS string)",
    "share_price": "cast(cast(l_discount AS decimal(15,6)) AS string)",
    "shares": "cast(cast(l_quantity AS decimal(15,4)) AS string)",
    "xr_rate": "cast(cast(l_tax AS decimal(15,6)) AS string)",
    "fund_id": "cast(l_partkey % 100 AS string)",
    "pay_period_end_date": "CASE WHEN l_linestatus = 'F' THEN " + iso("l_shipdate") + " END",
    "money_source": "l_returnflag || l_linestatus",
    "voucher_number": "cast(l_orderkey AS string)",
    "seq_oper_code": "CASE WHEN l_linenumber = 5 THEN 'D' ELSE 'A' END",
    "batch_date": "CASE l_returnflag WHEN 'A' THEN '20240101' WHEN 'N' THEN '20240102' ELSE '20240103' END",
}


def _txn_filler(place: int, name: str) -> str:
    """A value for a column without a rule: a date, or a number that differs
    from column to column, so a wrong mapping shows."""
    if name.endswith("_date"):
        return f"CASE WHEN l_linenumber = 2 THEN 'no date' ELSE {iso('l_shipdate')} END"
    return f"cast((l_partkey + {place}) % 89 AS string)"


def txn_raw_feed(where: str) -> str:
    cols = [f"{TXN_RAW_EXPR.get(c) or _txn_filler(i, c)} AS {c}" for i, c in enumerate(TXN_RAW_COLUMNS)]
    return "SELECT " + ",\n       ".join(cols) + f"\nFROM {{lineitem}} WHERE {where}"


TXN_NG_FEED = txn_raw_feed("l_linestatus = 'O'")
TXN_JB_FEED = txn_raw_feed("l_linestatus = 'F'")
TXN_FUNDS_FEED = """SELECT cast(p_partkey % 100 AS string) AS fund_iv, lpad(cast(p_size AS string), 6, '0') AS plan_number,
       p_brand AS fund_code, p_type AS price_id FROM {part}"""
TXN_PLANS_FEED = """SELECT lpad(cast(s_suppkey AS string), 6, '0') AS plan_number,
       CASE WHEN s_nationkey < 10 THEN 'NG' WHEN s_nationkey < 20 THEN 'JB' END AS client_id FROM {supplier}"""


# ---- division entity inputs ----------------------------------------------------
DIVISIONS_FEED = """SELECT 'C' || cast(c_custkey AS string) AS client_id, lpad(cast(c_nationkey AS string), 6, '0') AS plan_number,
       substring(c_mktsegment, 1, 3) AS div_sub_id, c_name AS address_city, c_mktsegment AS address_line_1,
       cast(NULL AS string) AS address_line_2, cast(NULL AS string) AS address_line_3, cast(c_nationkey AS string) AS address_state,
       cast(NULL AS string) AS address_zip_code, c_name AS primary_name, cast(NULL AS string) AS secondary_name,
       '2024-01-31' AS source_cycle_date
FROM {customer}"""
DETAILS_FEED = """SELECT lpad(cast(o_orderkey AS string), 9, '0') AS part_number, lpad(cast(o_orderkey % 25 AS string), 6, '0') AS plan_number,
       CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'AUT' WHEN '2' THEN 'BUI' WHEN '3' THEN 'FUR' WHEN '4' THEN 'HOU'
            ELSE '' END AS div_sub_id
FROM {orders}"""
# Plans under 8 hold allocated accounts only, plans from 20 on no account that meets a participant.
ACCOUNTS_FEED = """SELECT CASE WHEN l_orderkey % 25 >= 20 OR l_shipdate >= TIMESTAMP '1998-06-01' THEN 'no participant'
            ELSE lpad(cast(l_orderkey AS string), 9, '0') END AS participant_id, lpad(cast(l_orderkey % 25 AS string), 6, '0') AS plan_number,
       CASE WHEN l_returnflag = 'A' OR l_orderkey % 25 < 4 THEN 'alloc' WHEN l_returnflag = 'N' OR l_orderkey % 25 < 8 THEN 'ALOC '
            ELSE l_linestatus END AS participant_account_type_code
FROM {lineitem}"""


# ---- producer balance inputs -----------------------------------------------------
PRODUCER_FEED = """SELECT lpad(cast(o_custkey AS string), 9, '0') AS rep_tax_id_ssn,
       CASE WHEN o_orderpriority LIKE '5%' THEN '' ELSE o_orderpriority END AS producer_role_code_desc,
       CASE o_orderstatus WHEN 'F' THEN 'RIA/IAR' ELSE o_orderpriority END AS producer_role_type,
       lpad(cast(o_orderkey AS string), 13, '0') AS participant_id, lpad(cast(o_orderkey % 10 AS string), 6, '0') AS plan_number
FROM {orders}"""
CORE_FEED = f"""SELECT lpad(cast(l_orderkey AS string), 13, '0') || lpad(cast(l_linenumber AS string), 2, '0') AS participant_id,
       lpad(cast(l_orderkey % 10 AS string), 6, '0') AS plan_number,
       CASE WHEN l_linestatus = 'O' THEN NULL WHEN l_linenumber = 5 THEN 'not a date' ELSE {iso('l_shipdate')} END AS source_cycle_date,
       CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE cast(cast(l_extendedprice AS decimal(15,2)) AS string) END AS cash_value_amount,
       cast(cast(cast(l_tax AS decimal(15,2)) * 100 AS decimal(15,2)) AS string) AS sdba_cash_value_amount,
       CASE WHEN l_linenumber = 1 THEN NULL ELSE cast(cast(l_quantity AS decimal(15,2)) AS string) END AS ytd_contributions,
       CASE l_returnflag WHEN 'A' THEN 'EE' WHEN 'R' THEN 'ER' ELSE 'XX' END AS money_type_description
FROM {{lineitem}}"""
LOANS_FEED = """SELECT lpad(cast(o_orderkey % 10 AS string), 6, '0') AS plan_number,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'no loan ' ELSE '' END || lpad(cast(o_orderkey AS string), 13, '0') || 'L1' AS participant_id,
       CASE WHEN o_orderstatus = 'F' THEN 'PREMIER' ELSE 'OTHER' END AS source_system,
       cast(cast(cast(o_totalprice AS decimal(15,2)) * 0.5 AS decimal(15,2)) AS string) AS outstanding_principal_balance,
       CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE cast(cast(o_totalprice AS decimal(15,2)) AS string) END AS loan_balance
FROM {orders}"""
LIFE_FEED = f"""SELECT lpad(cast(o_orderkey % 10 AS string), 6, '0') AS plan_number,
       CASE WHEN o_orderstatus = 'P' THEN 'no life ' ELSE '' END || lpad(cast(o_orderkey AS string), 13, '0') || 'X9' AS participant_id,
       cast(cast(cast(o_totalprice AS decimal(15,2)) * 0.25 AS decimal(15,2)) AS string) AS cash_value_amt, {iso('o_orderdate')} AS valuation_date
FROM {{orders}}"""


# ---- staging feed for the raw job --------------------------------------------------
STAGING_FEED = f"""SELECT lpad(cast(o_custkey AS string), 6, '0') AS plan_number,
       CASE WHEN o_orderstatus = 'F' THEN 'NG' ELSE '' END AS client_id,
       lpad(cast(o_orderkey % 5000 AS string), 9, '0') AS participant_id,
       CASE WHEN o_orderpriority LIKE '3%' THEN replace(o_orderpriority, '-', chr(10)) ELSE o_orderpriority END AS status_text,
       {_date_render('cast(o_orderdate AS date)', 'o_orderkey')} AS trade_date,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {iso('o_orderdate')} END AS source_cycle_date,
       cast(cast(o_totalprice AS decimal(15,2)) AS string) AS amount,
       '20240131' AS batch_date
FROM {{orders}}"""

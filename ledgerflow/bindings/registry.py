"""Registered queries (Spark, via ledgerflow) and their DuckDB oracles.

Every query reads the supplied tables in full.  ``QUERIES[name](spark,
sf_dir)`` returns a DataFrame; ``ORACLES[name]`` is SQL over the DuckDB
views with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.bindings import feeds as fd
from ledgerflow.bindings.feeds import duck_sql, for_compare, ints_as_double, spark_sql, table
from ledgerflow.functions import amounts, cleansing, dates
from ledgerflow.operators import aggregates, joins, merge, quality, windows
from ledgerflow.operators.conform import union_conformed
from ledgerflow.plans.entities.transfer_balance import transfer_balance
from ledgerflow.sources import catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def with_feed(sql: str, body: str, name: str = "f") -> str:
    return f"WITH {name} AS ({duck_sql(sql)})\n{body}"


# ---------------------------------------------------------------- T5 -------
TRANSFER_NG = fd.transfer_feed("o_orderstatus <> 'F'")
TRANSFER_JB = fd.transfer_feed("o_orderstatus = 'F'")


def _transfer_oracle(feed: str, label: str) -> str:
    return f"""SELECT client_id, plan_number, participant_id, sequence_number AS transfer_balance_seq_number,
  cast(try_cast(source_cycle_date AS date) AS varchar) AS source_cycle_date, '{label}' AS source_system,
  cast(last_day(try_cast(source_cycle_date AS date)) AS varchar) AS source_month_end_date,
  from_fund_source AS from_fund_id, to_fund_source AS to_fund_id,
  cast(try_cast(allocation_percent AS decimal(7,4)) AS double) AS allocation_percent,
  cast(try_cast(amount AS decimal(14,2)) AS double) AS transfer_amount,
  activity AS activity_type, usage_code_1, usage_code_2, usage_code_3, usage_code_4, usage_code_5,
  cast(try_cast(rev_run_date AS date) AS varchar) AS reversal_run_date, rev AS reversal_type_flag
FROM ({duck_sql(feed)})"""


@register("transfer_balance", _transfer_oracle(TRANSFER_JB, "VRP-SP") + "\nUNION ALL\n" + _transfer_oracle(TRANSFER_NG, "VRP-PB"))
def q_transfer_balance(spark, sf):
    return for_compare(transfer_balance(spark_sql(spark, sf, TRANSFER_JB), spark_sql(spark, sf, TRANSFER_NG)))


# ---------------------------------------------------------------- S4 -------
_ORDERS_OUT = """o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"""


@register("scan_predicate", f"""SELECT {_ORDERS_OUT} FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority = '1-URGENT'""")
def q_scan_predicate(spark, sf):
    path = f"{sf.rstrip('/')}/orders.parquet"
    return for_compare(catalog.read_path_table(spark, path, {"o_orderstatus": ["F", "O"], "o_orderpriority": "1-URGENT"}))


# ---------------------------------------------------------------- C2 -------
@register("junk_clean", r"""SELECT doc_id, regexp_replace(nullif(text, ''), '[\n\r]', ' ', 'g') AS text,
  regexp_replace(nullif(lang, ''), '[\n\r]', ' ', 'g') AS lang,
  regexp_replace(nullif(source, ''), '[\n\r]', ' ', 'g') AS source, n_chars
FROM documents""")
def q_junk_clean(spark, sf):
    return cleansing.remove_junk_values(table(spark, sf, "documents"))


# ---------------------------------------------------------------- C3 -------
@register("cycle_fill", with_feed(fd.CYCLE_FEED, """SELECT event_id, user_id, event_type,
  coalesce(source_cycle_date, '2024-01-31') AS source_cycle_date, coalesce(run_date, '2024-01-31') AS run_date,
  other_date FROM f"""))
def q_cycle_fill(spark, sf):
    return cleansing.fill_cycle_dates(spark_sql(spark, sf, fd.CYCLE_FEED), "20240131")


# ---------------------------------------------------------------- C15 ------
@register("batch_cutoff", with_feed(fd.CUTOFF_FEED, """SELECT event_id, user_id, event_type, source_cycle_date,
  CASE WHEN source_cycle_date = '2024-01-15' THEN '20240114'
       WHEN source_cycle_date < '2024-01-15' THEN replace(source_cycle_date, '-', '')
       ELSE '20240114' END AS batch_date
FROM f WHERE length(source_cycle_date) = 10"""))
def q_batch_cutoff(spark, sf):
    return dates.batch_date_by_cutoff(spark_sql(spark, sf, fd.CUTOFF_FEED), "20240115", "10:30")


# ---------------------------------------------------------------- C4-C6 ----
_DUCK_PATTERNS = ["%Y-%m-%d", "%Y.%m.%d", "%Y/%m/%d", "%m-%d-%Y", "%m.%d.%Y", "%m/%d/%Y", "%m-%d-%y", "%m.%d.%y",
                  "%m/%d/%y", "%d-%m-%Y", "%d.%m.%Y", "%d/%m/%Y", "%d-%m-%y", "%d.%m.%y", "%d/%m/%y",
                  "%Y-%m-%d %H:%M:%S"]


def _duck_date(c: str) -> str:
    v = f"(CASE WHEN length({c}) < 8 OR {c} IN ({', '.join(repr(s) for s in dates.INVALID_DATE_STRINGS)}) THEN NULL ELSE {c} END)"
    tries = [f"try_strptime({v}, '{p}')" for p in _DUCK_PATTERNS]
    zoned = (f"CASE WHEN regexp_full_match({v}, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}\\.\\d{{3}}([+-]\\d{{4}}|[+-]\\d{{2}}:\\d{{2}}|Z)') "
             f"THEN try_strptime(substring({v}, 1, 10), '%Y-%m-%d') END")
    tries += [zoned, f"try_strptime({v}, '%Y%m%d')"]
    return f"cast(cast(coalesce({', '.join(tries)}) AS date) AS varchar)"


@register("date_formats", with_feed(fd.DATES_FEED, f"""SELECT o_orderkey, batch_date, o_orderpriority,
  {_duck_date('order_date')} AS order_date, {_duck_date('promise_dt')} AS promise_dt FROM f"""))
def q_date_formats(spark, sf):
    return dates.normalize_date_columns(spark_sql(spark, sf, fd.DATES_FEED, spread=True))


# ---------------------------------------------------------------- C9 -------
@register("default_fill", with_feed(fd.DEFAULTS_FEED, """SELECT c_custkey,
  coalesce(nullif(rev_code, ''), '0') AS rev_code, coalesce(nullif(client_id, ''), 'NG') AS client_id,
  coalesce(nullif(loan_type_id, ''), 'G') AS loan_type_id FROM f"""))
def q_default_fill(spark, sf):
    df = spark_sql(spark, sf, fd.DEFAULTS_FEED)
    return df.transform(cleansing.fill_rev_code).transform(cleansing.fill_client_id).transform(cleansing.fill_loan_type)


# ---------------------------------------------------------------- C12/C16 --
@register("remap", with_feed(fd.FUNDS_FEED, """SELECT p_partkey, fund_iv,
  CASE fund_iv WHEN '90' THEN 'LN90' WHEN '91' THEN 'LN91' ELSE fund_code END AS fund_code,
  CASE fund_iv WHEN '90' THEN 'LN90' WHEN '91' THEN 'LN91' ELSE price_id END AS price_id, beneficiary_type FROM f"""))
def q_remap(spark, sf):
    df = spark_sql(spark, sf, fd.FUNDS_FEED)
    return cleansing.remap_loan_funds(cleansing.remap_loan_funds(df, "fund_code"), "price_id")


@register("labels", with_feed(fd.FUNDS_FEED, """SELECT p_partkey, beneficiary_type,
  CASE beneficiary_type WHEN '1' THEN 'Individual' WHEN '2' THEN 'Organization' WHEN '3' THEN 'Trust'
       ELSE 'Unknown' END AS beneficiary_label FROM f"""))
def q_labels(spark, sf):
    df = spark_sql(spark, sf, fd.FUNDS_FEED)
    return df.select("p_partkey", "beneficiary_type", cleansing.beneficiary_label(F.col("beneficiary_type")).alias("beneficiary_label"))


# ---------------------------------------------------------------- C10/C11 --
@register("overpunch", """SELECT c_custkey, cast(cast(c_acctbal AS decimal(13,2)) AS double) AS cash FROM customer""")
def q_overpunch(spark, sf):
    df = spark_sql(spark, sf, fd.OVERPUNCH_FEED)
    decoded = amounts.decode_amounts(df, {"cash": (13, 2)})
    return decoded.select("c_custkey", F.col("cash").try_cast("decimal(13,2)").cast("double").alias("cash"))


@register("txn_amounts", """SELECT l_orderkey, l_linenumber,
  cast(cast(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS decimal(13,2)) AS double) AS cash,
  cast(cast(CASE WHEN l_linestatus = 'F' THEN -l_quantity ELSE l_quantity END AS decimal(13,4)) AS double) AS shares,
  cast(cast(CASE WHEN l_returnflag = 'A' THEN -l_discount ELSE l_discount END AS decimal(13,6)) AS double) AS share_price,
  cast(cast(CASE WHEN l_returnflag = 'N' THEN -l_tax ELSE l_tax END AS decimal(11,6)) AS double) AS xr_rate,
  CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN '0' ELSE cast(l_linenumber AS varchar) END AS rev_code
FROM lineitem""")
def q_txn_amounts(spark, sf):
    df = amounts.parse_txn_amounts(spark_sql(spark, sf, fd.TXN_AMOUNTS_FEED, spread=True))
    return df.select(
        "l_orderkey", "l_linenumber",
        *[F.col(c).try_cast(f"decimal({p},{s})").cast("double").alias(c)
          for c, (p, s) in amounts.TXN_AMOUNTS.items() if c in ("cash", "shares", "share_price", "xr_rate")],
        "rev_code",
    )


# ---------------------------------------------------------------- Q1/Q4/Q7 -
_LI_KEYS = ["l_orderkey", "l_linenumber"]
_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
_LI_ALL = [*_LI_KEYS, *_LI_REST, "batch_date"]
_LI_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in ["batch_date", *_LI_REST])
_LI_CTE = f"""WITH f AS ({duck_sql(fd.LINEITEM_FEED)}),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LI_ORDER}) AS rn FROM f)
"""


@register("dup_flag", _LI_CTE + f"""SELECT {', '.join(_LI_ALL)}, rn > 1 AS to_drop,
  CASE WHEN rn > 1 THEN 'duplicate record' END AS drop_record_remarks FROM r""")
def q_dup_flag(spark, sf):
    return quality.flag_duplicates(spark_sql(spark, sf, fd.LINEITEM_FEED, spread=True), _LI_KEYS, ["batch_date"])


@register("split_valid", _LI_CTE + f"SELECT {', '.join(_LI_ALL)} FROM r WHERE rn = 1")
def q_split_valid(spark, sf):
    return quality.valid_rows(quality.flag_duplicates(spark_sql(spark, sf, fd.LINEITEM_FEED, spread=True), _LI_KEYS, ["batch_date"]))


@register("split_rejected", _LI_CTE + f"""SELECT {', '.join(_LI_ALL)}, true AS to_drop,
  'duplicate record' AS drop_record_remarks FROM r WHERE rn > 1""")
def q_split_rejected(spark, sf):
    return quality.rejected_rows(quality.flag_duplicates(spark_sql(spark, sf, fd.LINEITEM_FEED, spread=True), _LI_KEYS, ["batch_date"]))


@register("drop_duplicates", _LI_CTE + f"SELECT {', '.join(_LI_ALL)} FROM r WHERE rn = 1")
def q_drop_duplicates(spark, sf):
    return quality.drop_duplicates_by_key(spark_sql(spark, sf, fd.LINEITEM_FEED, spread=True), _LI_KEYS, ["batch_date"])


# ---------------------------------------------------------------- Q2/Q3 ----
@register("range_flag", with_feed(fd.PLAN_FLAGS_FEED, """SELECT o_orderkey, plan_number, client_id, o_orderpriority,
  coalesce((plan_number BETWEEN '000001' AND '000040') OR (client_id = 'NG' AND plan_number IN ('999999', '999998', '999997')), false) AS to_drop,
  CASE WHEN (plan_number BETWEEN '000001' AND '000040') OR (client_id = 'NG' AND plan_number IN ('999999', '999998', '999997'))
       THEN 'invalid plan id' END AS drop_record_remarks FROM f"""))
def q_range_flag(spark, sf):
    return quality.flag_invalid_plan_ids(spark_sql(spark, sf, fd.PLAN_FLAGS_FEED))


@register("space_flag", with_feed(fd.SMA_FEED, """SELECT p_partkey, sma_fund_balance, p_type,
  coalesce(contains(sma_fund_balance, ' '), false) AS to_drop,
  CASE WHEN contains(sma_fund_balance, ' ') THEN 'invalid sma fund balance' END AS drop_record_remarks FROM f"""))
def q_space_flag(spark, sf):
    return quality.flag_invalid_sma_balance(spark_sql(spark, sf, fd.SMA_FEED))


# ---------------------------------------------------------------- W1-W3, J12
_EV_OUT = "event_id, user_id, event_type, strftime(transaction_date, '%Y-%m-%d %H:%M:%S') AS transaction_date, value, batch_date, source_cycle_date"


@register("surrogate_key", with_feed(fd.EVENTS_FEED, f"""SELECT {_EV_OUT},
  batch_date || '_' || cast(row_number() OVER (PARTITION BY user_id ORDER BY transaction_date ASC NULLS FIRST,
     event_id ASC NULLS FIRST, event_type ASC NULLS FIRST, value ASC NULLS FIRST, batch_date ASC NULLS FIRST,
     source_cycle_date ASC NULLS FIRST) AS varchar) AS newr_nqtxn_key FROM f"""))
def q_surrogate_key(spark, sf):
    df = spark_sql(spark, sf, fd.EVENTS_FEED)
    return for_compare(windows.number_within_key(df, ["user_id"], ["transaction_date"]))


@register("latest", with_feed(fd.EVENTS_FEED, f"""SELECT {_EV_OUT} FROM (
  SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY batch_date DESC) AS rk FROM f) WHERE rk = 1"""))
def q_latest(spark, sf):
    return for_compare(windows.latest_per_key(spark_sql(spark, sf, fd.EVENTS_FEED), ["user_id", "event_type"], "batch_date"))


@register("two_latest", with_feed(fd.EVENTS_FEED, f"""SELECT {_EV_OUT} FROM (
  SELECT *, rank() OVER (PARTITION BY user_id ORDER BY source_cycle_date DESC) AS rk FROM f) WHERE rk <= 2"""))
def q_two_latest(spark, sf):
    return for_compare(windows.top_ranks(spark_sql(spark, sf, fd.EVENTS_FEED), ["user_id"], "source_cycle_date", 2))


@register("two_latest_dense", with_feed(fd.EVENTS_FEED, f"""SELECT {_EV_OUT} FROM (
  SELECT *, dense_rank() OVER (PARTITION BY user_id, event_type ORDER BY source_cycle_date DESC) AS rk FROM f) WHERE rk <= 2"""))
def q_two_latest_dense(spark, sf):
    df = spark_sql(spark, sf, fd.EVENTS_FEED)
    return for_compare(windows.top_ranks(df, ["user_id", "event_type"], "source_cycle_date", 2, dense=True))


@register("last_batches", with_feed(fd.EVENTS_FEED, f"""SELECT {_EV_OUT} FROM f
WHERE batch_date IN (SELECT DISTINCT batch_date FROM f ORDER BY batch_date DESC LIMIT 2)"""))
def q_last_batches(spark, sf):
    return for_compare(joins.keep_latest_batches(spark_sql(spark, sf, fd.EVENTS_FEED), "batch_date", 2))


@register("distinct_batches", with_feed(fd.EVENTS_FEED, "SELECT DISTINCT batch_date FROM f"))
def q_distinct_batches(spark, sf):
    return quality.distinct_values(spark_sql(spark, sf, fd.EVENTS_FEED), "batch_date")


# ---------------------------------------------------------------- J1/J4-J6 -
@register("left_dims", """WITH oc AS (SELECT o_custkey, count(*) AS n_orders, sum(cast(o_totalprice AS decimal(15,2))) AS total
                  FROM orders GROUP BY o_custkey),
  asia AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 2)
SELECT c.c_custkey, c.c_name, n.n_name, r.r_name, a.n_name AS asia_nation, coalesce(oc.n_orders, 0) AS n_orders,
       cast(coalesce(oc.total, 0) AS double) AS total_price
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN asia a ON c.c_nationkey = a.n_nationkey
LEFT JOIN oc ON c.c_custkey = oc.o_custkey""")
def q_left_dims(spark, sf):
    c, n, r, o = (table(spark, sf, t) for t in ("customer", "nation", "region", "orders"))
    per_customer = o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("total"))
    n_small, r_small = joins.broadcast_if_small(n), joins.broadcast_if_small(r)
    asia = n.where(F.col("n_regionkey") == 2).select(F.col("n_nationkey").alias("a_key"), F.col("n_name").alias("asia_nation"))
    j = (c.join(n_small, c.c_nationkey == n_small.n_nationkey, "left")
         .join(r_small, F.col("n_regionkey") == r_small.r_regionkey, "left")
         .join(joins.broadcast_if_small(asia), c.c_nationkey == F.col("a_key"), "left")
         .join(per_customer, c.c_custkey == per_customer.o_custkey, "left"))
    return j.select("c_custkey", "c_name", "n_name", "r_name", "asia_nation",
                    F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                    F.coalesce("total", F.lit(0)).cast("double").alias("total_price"))


# ---------------------------------------------------------------- J3 -------
@register("null_safe", """WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer),
  s AS (SELECT nullif(c_mktsegment, 'BUILDING') AS seg, count(*) AS seg_count FROM customer GROUP BY 1)
SELECT c.c_custkey, c.seg, s.seg_count FROM c LEFT JOIN s ON coalesce(c.seg, '-9999') = coalesce(s.seg, '-9999')""")
def q_null_safe(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    seg = cust.groupBy(F.col("seg").alias("s_seg")).agg(F.count(F.lit(1)).alias("seg_count"))
    j = cust.join(seg, joins.sentinel_on(cust, seg, [("seg", "s_seg")]), "left")
    return j.select("c_custkey", "seg", "seg_count")


# half of the orders have no participant and half of those no plan either: one key holds a quarter of the rows
_HALF_NULL = """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS part, CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS plan FROM {orders}"""


@register("null_safe_dealt", f"""WITH o AS ({duck_sql(_HALF_NULL)}),
  s AS (SELECT part, plan, count(*) AS n, min(o_orderkey) AS least FROM o GROUP BY 1, 2)
SELECT o.o_orderkey, o.part, o.plan, s.n, s.least FROM o LEFT JOIN s
  ON coalesce(cast(o.part AS varchar), '-9999') = coalesce(cast(s.part AS varchar), '-9999') AND coalesce(o.plan, '-9999') = coalesce(s.plan, '-9999')""")
def q_null_safe_dealt(spark, sf):
    o = spark_sql(spark, sf, _HALF_NULL).withColumn("part", F.col("part").cast("string"))
    s = o.groupBy(F.col("part").alias("s_part"), F.col("plan").alias("s_plan")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("least"))
    j = joins.dealt_join(o, s, [("part", "s_part"), ("plan", "s_plan")])
    return j.select("o_orderkey", F.col("part").cast("long").alias("part"), "plan", "n", "least")


# ---------------------------------------------------------------- J10 ------
@register("right_join", """SELECT c.c_custkey, c.c_name, cast(o.o_orderkey AS varchar) AS o_orderkey, o.o_orderstatus
FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_right_join(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "right")
    return j.select("c_custkey", "c_name", F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus")


# ---------------------------------------------------------------- J7/J8 ----
@register("prefix_join", """WITH li AS (SELECT lpad(cast(l_orderkey AS varchar), 13, '0') || lpad(cast(l_linenumber AS varchar), 2, '0') AS pid15,
                    l_extendedprice FROM lineitem),
  od AS (SELECT lpad(cast(o_orderkey AS varchar), 13, '0') AS pid13, o_orderstatus FROM orders)
SELECT od.pid13, li.pid15, od.o_orderstatus, li.l_extendedprice
FROM od JOIN li ON od.pid13 = substring(li.pid15, 1, 13)""")
def q_prefix_join(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.concat(F.lpad(F.col("l_orderkey").cast("string"), 13, "0"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("pid15"),
        "l_extendedprice")
    od = table(spark, sf, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 13, "0").alias("pid13"), "o_orderstatus")
    return od.join(li, od.pid13 == joins.prefix(li.pid15), "inner").select("pid13", "pid15", "o_orderstatus", "l_extendedprice")


# ---------------------------------------------------------------- J11/J13 --
_SAME = """t.base_transaction_code = tt.base_transaction_code
       AND coalesce(try_cast(t.activity_type AS integer), -9999) = coalesce(try_cast(tt.activity_type AS integer), -9999)"""
# The rules as SQL of their own, not from the engine's tables.
_CASE_ON = f"""CASE
  WHEN t.base_transaction_code IN ('035', '363', '383', '387', '801', '813', '815', '820', '833', '844', '850', '851', '966')
    THEN t.base_transaction_code = tt.base_transaction_code
  WHEN t.usage_code_1 IN ('1', '2', '3', '4', '5', '6', '7', '8', '9', 'A', 'B', 'C', 'L') THEN t.usage_code_1 = tt.usage_code_1 AND {_SAME}
  WHEN t.usage_code_2 IN ('3', '7', '8', '9', 'A', 'C', 'L', 'O', 'T', 'U', 'V') THEN t.usage_code_2 = tt.usage_code_2 AND {_SAME}
  WHEN t.usage_code_3 IN ('8', '9') THEN t.usage_code_3 = tt.usage_code_3 AND {_SAME}
  WHEN t.usage_code_4 IN ('1', '2', '3', '4', '5', '6', '7', '8', '9', 'A', 'B', 'C', 'D', 'L', 'R', 'WR', 'X', 'Z')
    THEN t.usage_code_4 = tt.usage_code_4 AND {_SAME}
  WHEN t.usage_code_5 IN ('9') THEN t.usage_code_5 = tt.usage_code_5 AND {_SAME}
  WHEN t.standard_usage_code_4 IN ('1', '2', 'R') THEN t.standard_usage_code_4 = tt.standard_usage_code_4 AND {_SAME}
  ELSE CASE WHEN tt.usage_code_1 IS NULL AND tt.usage_code_2 IS NULL AND tt.usage_code_3 IS NULL AND tt.usage_code_4 IS NULL
      AND tt.usage_code_5 IS NULL AND tt.standard_usage_code_1 IS NULL AND tt.standard_usage_code_2 IS NULL
      AND tt.standard_usage_code_3 IS NULL AND tt.standard_usage_code_4 IS NULL AND tt.standard_usage_code_5 IS NULL
    THEN {_SAME} END END"""


@register("rule_join", f"""WITH t AS ({duck_sql(fd.RULE_TXN_FEED)}), tt AS ({duck_sql(fd.TYPES_FEED)})
SELECT t.l_orderkey, t.l_linenumber, t.base_transaction_code, t.activity_type, tt.category AS tt_category,
       tt.activity AS tt_activity, tt.activity_code_description AS tt_activity_code_description
FROM t LEFT JOIN tt ON {_CASE_ON}
WHERE tt.process_flag = 'Y'""")
def q_rule_join(spark, sf):
    t = spark_sql(spark, sf, fd.RULE_TXN_FEED, spread=True)
    tt = spark_sql(spark, sf, fd.TYPES_FEED).where(F.col("process_flag") == "Y")
    j = joins.rule_join(t, tt, how="inner")
    return j.select("l_orderkey", "l_linenumber", "base_transaction_code", "activity_type",
                    "tt_category", "tt_activity", "tt_activity_code_description")


# ---------------------------------------------------------------- J14 ------
_HALVES = """WITH a AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_acctbal END AS c_acctbal
                FROM customer WHERE c_nationkey < 15),
  b AS (SELECT c_custkey, upper(c_name) AS c_name, c_acctbal, c_mktsegment FROM customer WHERE c_nationkey >= 10)
"""


@register("merge_frames", _HALVES + """SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, coalesce(a.c_name, b.c_name) AS c_name,
  coalesce(a.c_acctbal, b.c_acctbal) AS c_acctbal, b.c_mktsegment
FROM a FULL JOIN b ON a.c_custkey = b.c_custkey""")
def q_merge_frames(spark, sf):
    c = table(spark, sf, "customer")
    a = c.where(F.col("c_nationkey") < 15).select(
        "c_custkey", "c_name", F.when(F.col("c_mktsegment") == "BUILDING", None).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    b = c.where(F.col("c_nationkey") >= 10).select("c_custkey", F.upper("c_name").alias("c_name"), "c_acctbal", "c_mktsegment")
    return joins.merge_frames(a, b, ["c_custkey"])


# ---------------------------------------------------------------- A1-A4, A10
@register("sums", """SELECT l_suppkey, l_returnflag, count(*) AS n_lines,
  cast(sum(coalesce(cast(l_extendedprice AS decimal(15,2)), 0)) AS double) AS sum_price,
  cast(sum(coalesce(cast(l_quantity AS decimal(15,2)), 0)) AS double) AS sum_qty
FROM lineitem GROUP BY l_suppkey, l_returnflag""")
def q_sums(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_suppkey", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(aggregates.zero_if_null(F.col("l_extendedprice").cast("decimal(15,2)"))).cast("double").alias("sum_price"),
        F.sum(aggregates.zero_if_null(F.col("l_quantity").cast("decimal(15,2)"))).cast("double").alias("sum_qty"))


@register("conditional_sums", """SELECT l_suppkey,
  cast(sum(coalesce(CASE WHEN l_linestatus = 'O' THEN cast(l_extendedprice AS decimal(15,2)) END, 0)) AS double) AS open_amount,
  cast(sum(coalesce(CASE WHEN l_linestatus = 'F' THEN cast(l_extendedprice AS decimal(15,2)) END, 0)) AS double) AS filled_amount,
  cast(sum(coalesce(CASE WHEN l_returnflag = 'R' THEN cast(l_extendedprice AS decimal(15,2))
                         ELSE cast(l_quantity AS decimal(15,2)) END, 0)) AS double) AS measure,
  cast(sum(coalesce(CASE WHEN l_linestatus = 'O' THEN cast(l_extendedprice AS decimal(15,2)) END, 0))
     + sum(coalesce(CASE WHEN l_linestatus = 'F' THEN cast(l_extendedprice AS decimal(15,2)) END, 0)) AS double) AS total_amount
FROM lineitem GROUP BY l_suppkey""")
def q_conditional_sums(spark, sf):
    li = table(spark, sf, "lineitem")
    price, qty = F.col("l_extendedprice").cast("decimal(15,2)"), F.col("l_quantity").cast("decimal(15,2)")
    g = li.groupBy("l_suppkey").agg(
        F.sum(aggregates.zero_if_null(F.when(F.col("l_linestatus") == "O", price))).alias("open_amount"),
        F.sum(aggregates.zero_if_null(F.when(F.col("l_linestatus") == "F", price))).alias("filled_amount"),
        F.sum(aggregates.zero_if_null(F.when(F.col("l_returnflag") == "R", price).otherwise(qty))).alias("measure"))
    return g.select("l_suppkey", *[F.col(c).cast("double").alias(c) for c in ("open_amount", "filled_amount", "measure")],
                    (F.col("open_amount") + F.col("filled_amount")).cast("double").alias("total_amount"))


# ---------------------------------------------------------------- A6 -------
@register("set_agg", """SELECT o_custkey,
  coalesce(string_agg(DISTINCT nullif(o_orderpriority, ''), ';' ORDER BY nullif(o_orderpriority, '')), '') AS producer_role_code,
  coalesce(string_agg(DISTINCT nullif(CASE WHEN o_orderstatus = 'RIA/IAR' THEN o_orderstatus ELSE substring(o_orderpriority, 1, 3) END, ''), ';'
        ORDER BY nullif(CASE WHEN o_orderstatus = 'RIA/IAR' THEN o_orderstatus ELSE substring(o_orderpriority, 1, 3) END, '')), '') AS producer_role_type
FROM orders GROUP BY o_custkey""")
def q_set_agg(spark, sf):
    o = table(spark, sf, "orders")
    role_src = F.when(F.col("o_orderstatus") == aggregates.ROLE_TYPE_WHOLE, F.col("o_orderstatus")).otherwise(F.col("o_orderpriority"))
    return aggregates.distinct_concat(o, ["o_custkey"], {
        "producer_role_code": F.col("o_orderpriority"),
        "producer_role_type": aggregates.role_type_code(role_src),
    })


# ---------------------------------------------------------------- A5/A8/A7 -
_ACCT = """CASE o_orderstatus WHEN 'F' THEN ' alloc ' WHEN 'O' THEN 'ALOC' ELSE substring(o_orderpriority, 1, 1) END"""


@register("set_flag", f"""WITH m AS (SELECT o_custkey,
     CASE WHEN upper(trim({_ACCT})) IN ('ALLOC', 'ALOC') THEN 'ALLOC' ELSE {_ACCT} END AS acct FROM orders),
  s AS (SELECT o_custkey, list_distinct(list(acct)) AS st FROM m GROUP BY o_custkey)
SELECT c.c_custkey, CASE WHEN len(s.st) = 1 AND s.st[1] = 'ALLOC' THEN 'N' ELSE 'Y' END AS plan_unallocated_flag
FROM customer c LEFT JOIN s ON c.c_custkey = s.o_custkey""")
def q_set_flag(spark, sf):
    o = table(spark, sf, "orders")
    acct = F.when(F.col("o_orderstatus") == "F", F.lit(" alloc ")).when(F.col("o_orderstatus") == "O", F.lit("ALOC")) \
        .otherwise(F.substring("o_orderpriority", 1, 1))
    summary = aggregates.allocation_summary(o.withColumn("acct", acct), ["o_custkey"], "acct")
    c = table(spark, sf, "customer")
    j = c.join(summary, c.c_custkey == summary.o_custkey, "left")
    return j.select("c_custkey", aggregates.unallocated_flag(F.col("_acct_n"), F.col("_acct_min"), F.col("_acct_max")).alias("plan_unallocated_flag"))


@register("first_code", """SELECT o_custkey, substring(min(o_orderpriority), 1, 3) AS company_code FROM orders GROUP BY o_custkey""")
def q_first_code(spark, sf):
    return aggregates.first_code(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", "company_code")


# ---------------------------------------------------------------- O2-O4 ----
PARTY = [("party_id", "bigint"), ("party_name", "string"), ("nation_key", "int"), ("balance", "decimal(15,2)"),
         ("segment", "string"), ("party_type", "string"), ("onboard_date", "date")]


@register("conform_union", """SELECT c_custkey AS party_id, c_name AS party_name, c_nationkey AS nation_key,
  cast(cast(c_acctbal AS decimal(15,2)) AS double) AS balance, c_mktsegment AS segment, 'customer' AS party_type,
  cast(NULL AS varchar) AS onboard_date FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, cast(cast(s_acctbal AS decimal(15,2)) AS double), NULL, 'supplier', NULL FROM supplier""")
def q_conform_union(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("party_name"), F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("party_type"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("party_name"), F.col("s_nationkey").alias("nation_key"),
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("party_type"))
    return for_compare(union_conformed([c, s], PARTY))


# ---------------------------------------------------------------- K5-K8 ----
MERGE_TARGET = """SELECT o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS decimal(15,2)) AS o_totalprice, o_orderpriority
FROM {orders} WHERE o_orderdate < TIMESTAMP '1998-01-01'"""
MERGE_SOURCE = """SELECT o_orderkey, o_custkey, 'U' || o_orderstatus AS o_orderstatus,
  cast(o_totalprice AS decimal(15,2)) + 1 AS o_totalprice, o_orderpriority,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'D' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'U' END AS seq_oper_code
FROM {orders} WHERE o_orderdate >= TIMESTAMP '1997-01-01'"""
_M_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
_MERGE_CTE = f"WITH t AS ({duck_sql(MERGE_TARGET)}), s AS ({duck_sql(MERGE_SOURCE)})\n"
_M_OUT = "o_orderkey, o_custkey, o_orderstatus, cast(o_totalprice AS double) AS o_totalprice, o_orderpriority"


def _merge_inputs(spark, sf):
    return spark_sql(spark, sf, MERGE_TARGET), spark_sql(spark, sf, MERGE_SOURCE)


@register("merge_upsert", _MERGE_CTE + f"""SELECT {_M_OUT} FROM (
  SELECT {', '.join(f'CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in _M_COLS)}
  FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
  UNION ALL SELECT {', '.join(f's.{c}' for c in _M_COLS)} FROM s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM t))""")
def q_merge_upsert(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return for_compare(merge.merge_frame(t, s, merge.upsert_spec(["o_orderkey"])))


@register("merge_delete", _MERGE_CTE + f"""SELECT {_M_OUT} FROM (
  SELECT {', '.join(f'CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in _M_COLS)}
  FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey WHERE NOT coalesce(s.seq_oper_code = 'D', false)
  UNION ALL SELECT {', '.join(f's.{c}' for c in _M_COLS)} FROM s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM t))""")
def q_merge_delete(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return for_compare(merge.merge_frame(t, s, merge.upsert_spec(["o_orderkey"], delete_code_col="seq_oper_code")))


@register("merge_update_first", _MERGE_CTE + f"""SELECT {_M_OUT} FROM (
  SELECT t.o_orderkey, t.o_custkey,
    CASE WHEN s.seq_oper_code = 'U' THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
    CASE WHEN s.seq_oper_code = 'U' THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
    t.o_orderpriority
  FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
  WHERE NOT coalesce(s.seq_oper_code <> 'U' AND s.o_orderpriority = '5-LOW', false)
  UNION ALL SELECT {', '.join(f's.{c}' for c in _M_COLS)} FROM s
  WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM t) AND coalesce(s.seq_oper_code <> 'D', false))""")
def q_merge_update_first(spark, sf):
    """Update-before-delete, a delete condition combined with the
    merge condition, partial update values and a conditional insert."""
    t, s = _merge_inputs(spark, sf)
    spec = merge.MergeSpec(
        merge.key_pairs(["o_orderkey"]),
        (merge.Clause("update", "source.seq_oper_code = 'U'",
                      {"o_orderstatus": "source.o_orderstatus", "o_totalprice": "source.o_totalprice"}),
         merge.Clause("delete", "source.o_orderpriority = '5-LOW'"),
         merge.Clause("insert", "source.seq_oper_code <> 'D'")),
    )
    return for_compare(merge.merge_frame(t, s, spec))


@register("merge_delete_only", _MERGE_CTE + f"""SELECT {_M_OUT} FROM t
WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM s WHERE seq_oper_code = 'D')""")
def q_merge_delete_only(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return for_compare(merge.merge_frame(t, s, merge.delete_only_spec(["o_orderkey"], "source.seq_oper_code = 'D'")))


@register("delete_anti", _MERGE_CTE + f"""SELECT {_M_OUT} FROM t
WHERE t.o_orderkey NOT IN (SELECT o_orderkey FROM s WHERE seq_oper_code = 'D')""")
def q_delete_anti(spark, sf):
    t, s = _merge_inputs(spark, sf)
    return for_compare(merge.delete_matching(t, s, ["o_orderkey"], "source.seq_oper_code = 'D'"))


ID_TARGET = """SELECT lpad(cast(o_custkey AS string), 9, '0') AS participant_id, o_orderkey, o_orderstatus FROM {orders}"""
ID_CHANGES = """SELECT CASE c_mktsegment WHEN 'BUILDING' THEN '850' WHEN 'MACHINERY' THEN '851' ELSE '999' END AS admin_tran_code,
  lpad(cast(c_custkey AS string), 9, '0') AS old_participant_id, 'N' || lpad(cast(c_custkey AS string), 8, '0') AS new_participant_id
FROM {customer}"""


@register("key_rewrite", f"""WITH t AS ({duck_sql(ID_TARGET)}), m AS ({duck_sql(ID_CHANGES)} )
SELECT coalesce(m.new_participant_id, t.participant_id) AS participant_id, t.o_orderkey, t.o_orderstatus
FROM t LEFT JOIN (SELECT * FROM m WHERE admin_tran_code IN ('850', '851')) m ON t.participant_id = m.old_participant_id""")
def q_key_rewrite(spark, sf):
    t = spark_sql(spark, sf, ID_TARGET)
    changes = spark_sql(spark, sf, ID_CHANGES).where(F.col("admin_tran_code").isin("850", "851"))
    return merge.merge_frame(t, changes, merge.key_rewrite_spec())


@register("key_rewrite_join", f"""WITH t AS ({duck_sql(ID_TARGET)}), m AS ({duck_sql(ID_CHANGES)} )
SELECT coalesce(m.new_participant_id, t.participant_id) AS participant_id, t.o_orderkey, t.o_orderstatus
FROM t LEFT JOIN (SELECT * FROM m WHERE admin_tran_code IN ('850', '851')) m ON t.participant_id = m.old_participant_id""")
def q_key_rewrite_join(spark, sf):
    t = spark_sql(spark, sf, ID_TARGET)
    changes = spark_sql(spark, sf, ID_CHANGES).where(F.col("admin_tran_code").isin("850", "851"))
    return merge.rewrite_keys(t, changes)


# ---------------------------------------------------------------- S1-S3 ----
from ledgerflow.session import scratch_path  # noqa: E402
from ledgerflow.sinks import writers  # noqa: E402
from ledgerflow.sources import files  # noqa: E402

_ORDERS_TEXT = f"""SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey, o_orderstatus,
  cast(cast(o_totalprice AS decimal(15,2)) AS varchar) AS o_totalprice, {fd.iso('o_orderdate')} AS o_orderdate, o_orderpriority
FROM orders"""
_MIXED = ["O_OrderKey", "O_CustKey", "O_OrderStatus", "O_TotalPrice", "O_OrderDate", "O_OrderPriority"]


@register("delimited", _ORDERS_TEXT)
def q_delimited(spark, sf):
    o = table(spark, sf, "orders")
    padded = o.select(*[F.concat(F.lit("  "), c.cast("string"), F.lit(" ")).alias(n) for c, n in zip([
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice").cast("decimal(15,2)"),
        F.col("o_orderdate").cast("date"), F.col("o_orderpriority")], _MIXED)])
    path = scratch_path(spark, "psv")
    (padded.write.option("header", "true").option("delimiter", "|").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(path))
    schema = ", ".join(f"{n} string" for n in _MIXED)
    return files.read_feed(spark, f"{path}/part-*", "delimited", schema=schema, file_format="psv", header=True)


@register("delimited_csv", _ORDERS_TEXT)
def q_delimited_csv(spark, sf):
    o = table(spark, sf, "orders")
    plain = o.select(F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus",
                     F.col("o_totalprice").cast("decimal(15,2)").cast("string"), F.col("o_orderdate").cast("date").cast("string"),
                     "o_orderpriority")
    path = scratch_path(spark, "csv")
    plain.write.option("header", "false").csv(path)
    schema = ", ".join(f"{n} string" for n in _MIXED)
    return files.read_delimited(spark, f"{path}/part-*", schema, "csv", header=False)


FIXED_LAYOUT = {
    "O_ORDERKEY": {"start": 1, "end": 10, "type": "string"},
    "O_ORDERSTATUS": {"start": 11, "end": 11, "type": "string"},
    "O_CUSTKEY": {"start": 13, "end": 20, "type": "int"},
    "O_ORDERPRIORITY": {"start": 21, "end": 36, "type": "string"},
    "O_TOTALPRICE": {"start": 37, "end": 50, "type": "string"},
}
_FIXED_ORACLE = """SELECT lpad(cast(o_orderkey AS varchar), 10, '0') AS o_orderkey, o_orderstatus, cast(o_custkey AS varchar) AS o_custkey,
  o_orderpriority, cast(cast(o_totalprice AS decimal(15,2)) AS varchar) AS o_totalprice FROM orders"""


def _fixed_lines(spark, sf):
    o = table(spark, sf, "orders")
    line = F.concat(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.col("o_orderstatus"), F.lit("\x00\x00"),
        F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.rpad("o_orderpriority", 16, " "),
        F.lpad(F.col("o_totalprice").cast("decimal(15,2)").cast("string"), 14, " "))
    comment = o.select(F.concat(F.lit("-- orders with status "), F.col("o_orderstatus")).alias("value")).distinct()
    return comment.unionByName(o.select(line.alias("value")))


@register("fixed_width", _FIXED_ORACLE)
def q_fixed_width(spark, sf):
    path = scratch_path(spark, "fixed")
    _fixed_lines(spark, sf).write.text(path)
    return files.read_feed(spark, f"{path}/part-*", "fixed_width", layout=FIXED_LAYOUT)


@register("fixed_width_utf16", _FIXED_ORACLE)
def q_fixed_width_utf16(spark, sf):
    path = scratch_path(spark, "fixed16")
    (_fixed_lines(spark, sf).write.option("encoding", "UTF-16").option("quote", "\u0001")
     .option("header", "false").csv(path))
    return files.read_feed(spark, f"{path}/part-*", "fixed_width", layout=FIXED_LAYOUT, encoding="UTF-16")


# ---------------------------------------------------------------- K2/K4/K5 -
@register("dyn_overwrite", """SELECT o_orderkey, o_custkey, o_orderstatus,
  cast(cast(o_totalprice AS decimal(15,2)) + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS double) AS o_totalprice
FROM orders""")
def q_dyn_overwrite(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"), "o_orderstatus")
    path = scratch_path(spark, "dyn")
    writers.overwrite(o, path, ["o_orderstatus"])
    changed = o.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    writers.overwrite(changed, path, ["o_orderstatus"])
    return for_compare(spark.read.parquet(path))


@register("versioned_merge", _MERGE_CTE + f"""SELECT {_M_OUT} FROM (
  SELECT {', '.join(f'CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in _M_COLS)}
  FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey WHERE NOT coalesce(s.seq_oper_code = 'D', false)
  UNION ALL SELECT {', '.join(f's.{c}' for c in _M_COLS)} FROM s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM t))""")
def q_versioned_merge(spark, sf):
    t, s = _merge_inputs(spark, sf)
    base = scratch_path(spark, "table")
    writers.write_version(t, base)
    writers.merge_into(spark, base, s, merge.upsert_spec(["o_orderkey"], delete_code_col="seq_oper_code"))
    export = scratch_path(spark, "export")
    writers.export_parquet(writers.read_current(spark, base), export)
    return for_compare(spark.read.parquet(export))


@register("partition_merge", _MERGE_CTE + f"""SELECT {_M_OUT} FROM (
  SELECT {', '.join(f'CASE WHEN s.o_orderkey IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}' for c in _M_COLS)}
  FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey AND t.o_orderpriority = s.o_orderpriority
  WHERE NOT coalesce(s.seq_oper_code = 'D', false)
  UNION ALL SELECT {', '.join(f's.{c}' for c in _M_COLS)} FROM s WHERE s.o_orderkey NOT IN (SELECT o_orderkey FROM t))""")
def q_partition_merge(spark, sf):
    t, s = _merge_inputs(spark, sf)
    path = scratch_path(spark, "ptable")
    writers.overwrite(t, path, ["o_orderpriority"])
    spec = merge.upsert_spec(["o_orderkey", "o_orderpriority"], delete_code_col="seq_oper_code")
    writers.merge_into_partitions(spark, path, s, spec, ["o_orderpriority"])
    return for_compare(spark.read.parquet(path))


# ---------------------------------------------------------------- T1 -------
from ledgerflow.plans.entities import txn as txn_entity  # noqa: E402
from ledgerflow.plans.entities.div_sub import div_sub  # noqa: E402
from ledgerflow.plans.entities.producer_balance import producer_balance  # noqa: E402


AS_OF = "2024-02-01"  # fills missing dates in the bound entities, so results do not follow the clock


# The transaction columns, by how they are taken from the feed ("target" or "target=source").
_TXN_TEXTS = """
    margin_code reversal_reason money_source fund_iv=fund_id standard_usage_code_1 standard_usage_code_2
    standard_usage_code_3 standard_usage_code_4 standard_usage_code_5 trade_type usage_code_1 usage_code_2
    usage_code_3 usage_code_4 usage_code_5 use_plan_year_flag record_type rec_type plan_sequence pend_stat
    currency_code xr_type rec_code plan_num fileid_name fileid_ext fileid_ptr_indic tran_code part_num_x
    part_sub_plan part_ext1 fund_src etin_num separate_acct company_code share_class seq_oper_code part_ext
"""
_TXN_INTEGERS = """
    alt_posting_process_counter=alternate_posting_process_counter associated_activity sub_activity_code=sub_activity
    voucher_number part_num tran_seq
"""
_TXN_DATES = "pay_period_end_date previous_activity_date reverse_run_date"
_TXN_AMOUNTS = """
    13,2:cash 13,2:other_cash 15,2:reserved_cash_shares_ind 13,2:share_cost 13,6:share_price 13,4:shares
    13,2:uninvested_cash 13,2:currency_value 11,6:xr_rate 13,2:net_currency_value
"""


def _txn_duck_columns(label: str, client_default: str) -> str:
    def pairs(listed):
        return [(target, source or target) for target, _, source in (e.partition("=") for e in listed.split())]

    keys = ("participant_id", "plan_number", "base_transaction_code", "activity_type", "run_time", "sequence_number",
            "posting_process_counter")
    cols = [f"coalesce(t1.{c}, '-9999') AS {c}" for c in keys]
    cols += [f"cast(coalesce(try_cast(t1.{c} AS date), DATE '{AS_OF}') AS varchar) AS {c}" for c in ("trade_date", "run_date")]
    cols += [
        "coalesce(nullif(t1.rev_code, ''), '0') AS rev_code", f"coalesce(pld.client_id, '{client_default}') AS client_id",
        "tt1.category AS category", "tt1.activity AS activity", "tt1.activity_code_description AS activity_code_description",
        "pf.fund_number AS fund_number", f"'{label}' AS source_system",
        "cast(NULL AS varchar) AS source_processing_date", "cast(NULL AS varchar) AS source_cycle_date",
    ]
    cols += [f"t1.{source} AS {target}" for target, source in pairs(_TXN_TEXTS)]
    cols += [f"cast(try_cast(t1.{source} AS integer) AS double) AS {target}" for target, source in pairs(_TXN_INTEGERS)]
    cols += [f"cast(try_cast(t1.{c} AS date) AS varchar) AS {c}" for c in _TXN_DATES.split()]
    cols += [f"cast(try_cast(t1.{c} AS decimal({size})) AS double) AS {c}" for size, _, c in (e.partition(":") for e in _TXN_AMOUNTS.split())]
    return ",\n  ".join(cols)


def _txn_duck_channel(feed, fund_col, label, client_default, latest=True, rules=_CASE_ON):
    return f"""SELECT {_txn_duck_columns(label, client_default)}, t1.batch_date
FROM (SELECT * FROM ({duck_sql(feed)}) x {f"WHERE batch_date IN (SELECT DISTINCT batch_date FROM ({duck_sql(feed)}) y ORDER BY 1 DESC LIMIT 2)" if latest else ""}) t1
LEFT JOIN (SELECT fund_iv, plan_number, {fund_col} AS fund_number FROM ({duck_sql(fd.TXN_FUNDS_FEED)})) pf
  ON t1.fund_id = pf.fund_iv AND t1.plan_number = pf.plan_number
LEFT JOIN (SELECT plan_number, client_id FROM ({duck_sql(fd.TXN_PLANS_FEED)})) pld ON pld.plan_number = t1.plan_number
LEFT JOIN ({duck_sql(fd.TYPES_FEED)}) tt1 ON {rules.replace('t.', 't1.').replace('tt1.', 'tt.').replace('tt.', 'tt1.')}
WHERE t1.participant_id <> '000000000' AND tt1.process_flag = 'Y'"""


_TXN_KEY = ("activity_type, base_transaction_code, participant_id, plan_number, posting_process_counter, rev_code, "
            "run_date, run_time, trade_date, sequence_number")
_TXN_ORACLE = f"""WITH u AS ({_txn_duck_channel(fd.TXN_NG_FEED, 'fund_code', 'VRP-PB', 'NG')}
UNION ALL {_txn_duck_channel(fd.TXN_JB_FEED, 'price_id', 'VRP-SP', '-9999')}),
r AS (SELECT *, rank() OVER (PARTITION BY {_TXN_KEY} ORDER BY batch_date DESC) AS rk FROM u)
SELECT * EXCLUDE (batch_date, rk) FROM r WHERE rk = 1"""


def _txn_inputs(spark, sf):
    funds, plans = spark_sql(spark, sf, fd.TXN_FUNDS_FEED), spark_sql(spark, sf, fd.TXN_PLANS_FEED)
    ng = {"feed": spark_sql(spark, sf, fd.TXN_NG_FEED, spread=True), "funds": funds, "plans": plans}
    jb = {"feed": spark_sql(spark, sf, fd.TXN_JB_FEED, spread=True), "funds": funds, "plans": plans}
    return ng, jb, spark_sql(spark, sf, fd.TYPES_FEED)


def _rendered(df):
    return ints_as_double(for_compare(df))


@register("txn", _TXN_ORACLE)
def q_txn(spark, sf):
    ng, jb, types = _txn_inputs(spark, sf)
    return txn_entity.txn(ng, jb, types, as_of=AS_OF, render=_rendered)


_TXN_SINGLE_RULES = _CASE_ON.replace("'035', ", "'35', ").replace("'815', ", "")


@register("txn_single_feed", f"""SELECT * EXCLUDE (batch_date) FROM (
{_txn_duck_channel(fd.TXN_JB_FEED, 'price_id', 'VRP-SP', '-9999', latest=False, rules=_TXN_SINGLE_RULES)}) u""")
def q_txn_single_feed(spark, sf):
    _, jb, types = _txn_inputs(spark, sf)
    return txn_entity.txn_single_feed(jb["feed"], jb["funds"], jb["plans"], types, as_of=AS_OF, render=_rendered)


# ---------------------------------------------------------------- T4 -------
@register("div_sub", f"""WITH dpg AS ({duck_sql(fd.DIVISIONS_FEED)}), op AS ({duck_sql(fd.DETAILS_FEED)}), sp AS ({duck_sql(fd.ACCOUNTS_FEED)}),
ptd AS (SELECT list_distinct(list(account_type_code)) AS st, div_sub_id, plan_number FROM (
    SELECT CASE WHEN upper(trim(sp.participant_account_type_code)) IN ('ALLOC', 'ALOC') THEN 'ALLOC'
                ELSE sp.participant_account_type_code END AS account_type_code, op.div_sub_id, op.plan_number
    FROM sp RIGHT JOIN op ON op.part_number = sp.participant_id AND op.plan_number = sp.plan_number
    WHERE op.div_sub_id IS NOT NULL AND op.div_sub_id <> '') x GROUP BY div_sub_id, plan_number)
SELECT client_id, dpg.plan_number, dpg.div_sub_id, cast(NULL AS varchar) AS div_sub_key, address_city, address_line_1,
  address_line_2, address_line_3, address_state, address_zip_code, primary_name, secondary_name, 'VRP-PB' AS source_system,
  source_cycle_date,
  CASE WHEN len(ptd.st) = 1 AND ptd.st[1] = 'ALLOC' THEN 'N' WHEN len(ptd.st) = 0 THEN NULL ELSE 'Y' END AS plan_unallocated_flag
FROM dpg LEFT JOIN ptd ON dpg.plan_number = ptd.plan_number AND dpg.div_sub_id = ptd.div_sub_id""")
def q_div_sub(spark, sf):
    return div_sub(spark_sql(spark, sf, fd.DIVISIONS_FEED), spark_sql(spark, sf, fd.ACCOUNTS_FEED, spread=True), spark_sql(spark, sf, fd.DETAILS_FEED))


# ---------------------------------------------------------------- T6 -------
_ROLE_T = "CASE WHEN producer_role_type = 'RIA/IAR' THEN producer_role_type ELSE substring(producer_role_type, 1, 3) END"


def _money(column):
    return f"try_cast({column} AS decimal(17,2))"


_PRODUCER_ORACLE = f"""WITH producer AS ({duck_sql(fd.PRODUCER_FEED)}), participant_core_balance AS ({duck_sql(fd.CORE_FEED)}),
participant_loan AS ({duck_sql(fd.LOANS_FEED)}), participant_life_fund_monthly AS ({duck_sql(fd.LIFE_FEED)}),
pr AS (SELECT rep_tax_id_ssn,
    coalesce(string_agg(DISTINCT nullif(producer_role_code_desc, ''), ';' ORDER BY nullif(producer_role_code_desc, '')), '') AS producer_role_code,
    coalesce(string_agg(DISTINCT nullif({_ROLE_T}, ''), ';' ORDER BY nullif({_ROLE_T}, '')), '') AS producer_role_type,
    participant_id, plan_number
  FROM producer GROUP BY participant_id, plan_number, rep_tax_id_ssn),
m1 AS (SELECT plan_number, participant_id, source_cycle_date,
    sum(cash_value) AS core_cash_value_amount, sum(coalesce(ee_cash_value, 0)) AS ee_cash_value_amount,
    sum(coalesce(er_cash_value, 0)) AS er_cash_value_amount, sum(ytd_contributions) AS ytd_contributions,
    sum(brokerage_account_cash_value) AS sdba_cash_value_amount
  FROM (SELECT participant_id, plan_number, coalesce(try_cast(source_cycle_date AS date), DATE '{AS_OF}' - 1) AS source_cycle_date,
          coalesce({_money('cash_value_amount')}, 0) AS cash_value, coalesce({_money('sdba_cash_value_amount')}, 0) AS brokerage_account_cash_value,
          coalesce({_money('ytd_contributions')}, 0.00) AS ytd_contributions,
          CASE WHEN money_type_description = 'EE' THEN {_money('cash_value_amount')} END AS ee_cash_value,
          CASE WHEN money_type_description = 'ER' THEN {_money('cash_value_amount')} END AS er_cash_value
        FROM participant_core_balance) x
  GROUP BY plan_number, participant_id, source_cycle_date),
m2 AS (SELECT plan_number, participant_id, sum(coalesce(total_loan_balance, 0)) AS total_loan_balance FROM (
    SELECT coalesce(plan_number, '-9999') AS plan_number, coalesce(participant_id, '-9999') AS participant_id,
      CASE WHEN source_system = 'PREMIER' THEN {_money('outstanding_principal_balance')} ELSE {_money('loan_balance')} END AS total_loan_balance
    FROM participant_loan) y GROUP BY plan_number, participant_id),
m3 AS (SELECT plan_number, sum(coalesce({_money('cash_value_amt')}, 0)) AS life_cash_value_amount_monthly, participant_id,
    valuation_date AS life_valuation_date FROM participant_life_fund_monthly GROUP BY plan_number, valuation_date, participant_id),
m AS (SELECT pr.rep_tax_id_ssn, pr.plan_number, pr.producer_role_code, pr.producer_role_type, pr.participant_id,
    m1.source_cycle_date, m1.core_cash_value_amount, m1.ee_cash_value_amount, m1.er_cash_value_amount, m1.ytd_contributions,
    m1.sdba_cash_value_amount, coalesce(m2.total_loan_balance, 0) AS loan_cash_value_amount,
    cast(m3.life_cash_value_amount_monthly AS decimal(17,2)) AS life_cash_value_amount_monthly, m3.life_valuation_date,
    coalesce(m2.total_loan_balance, 0) + coalesce(m1.sdba_cash_value_amount, 0) + coalesce(m3.life_cash_value_amount_monthly, 0) AS non_core
  FROM pr JOIN m1 ON coalesce(pr.plan_number, '-9999') = coalesce(m1.plan_number, '-9999')
      AND coalesce(pr.participant_id, '-9999') = coalesce(substring(m1.participant_id, 1, 13), '-9999')
    LEFT JOIN m2 ON m1.plan_number = m2.plan_number AND substring(m1.participant_id, 1, 13) = substring(m2.participant_id, 1, 13)
    LEFT JOIN m3 ON coalesce(m3.plan_number, '-9999') = coalesce(m1.plan_number, '-9999')
      AND coalesce(substring(m3.participant_id, 1, 13), '-9999') = coalesce(substring(m1.participant_id, 1, 13), '-9999'))
SELECT coalesce(rep_tax_id_ssn, '-9999') AS rep_tax_id_ssn, coalesce(plan_number, '-9999') AS plan_number,
  coalesce(substring(participant_id, 1, 13), '-9999') AS participant_id, producer_role_code, producer_role_type,
  cast(cast(coalesce(core_cash_value_amount, 0) AS decimal(17,2)) AS double) AS core_cash_value_amount,
  cast(cast(coalesce(non_core, 0) AS decimal(17,2)) AS double) AS noncore_cash_value_amount,
  cast(cast(coalesce(ee_cash_value_amount, 0) AS decimal(17,2)) AS double) AS ee_cash_value_amount,
  cast(cast(coalesce(er_cash_value_amount, 0) AS decimal(17,2)) AS double) AS er_cash_value_amount,
  cast(cast(coalesce(sdba_cash_value_amount, 0) AS decimal(17,2)) AS double) AS sdba_cash_value_amount,
  cast(cast(coalesce(loan_cash_value_amount, 0) AS decimal(17,2)) AS double) AS loan_cash_value_amount,
  cast(cast(coalesce(life_cash_value_amount_monthly, 0) AS decimal(17,2)) AS double) AS life_cash_value_amount_monthly,
  life_valuation_date,
  cast(cast(coalesce(ytd_contributions, 0) AS decimal(17,2)) AS double) AS ytd_contributions,
  cast(source_cycle_date AS varchar) AS source_cycle_date
FROM m"""


@register("producer_balance", _PRODUCER_ORACLE)
def q_producer_balance(spark, sf):
    return for_compare(producer_balance(
        spark_sql(spark, sf, fd.PRODUCER_FEED), spark_sql(spark, sf, fd.CORE_FEED, spread=True),
        spark_sql(spark, sf, fd.LOANS_FEED), spark_sql(spark, sf, fd.LIFE_FEED), as_of=AS_OF))


# ---------------------------------------------------------------- T7-T9 ----
from ledgerflow.plans import id_rewrite, raw_load, transform_load  # noqa: E402

_RAW_PARAMS = raw_load.FeedParams(
    source_name="tpch", file_name="SUPER_OMNI_ORDERS", table_name="orders_raw", file_load="full_load",
    primary_keys=("plan_number", "participant_id"),
)
_STAGE_CLEAN = r"""regexp_replace(nullif({c}, ''), '[\n\r]', ' ', 'g')"""
_RAW_ORACLE = f"""WITH s AS ({duck_sql(fd.STAGING_FEED)}),
j AS (SELECT {', '.join(_STAGE_CLEAN.format(c=c) + ' AS ' + c for c in
      ['plan_number', 'client_id', 'participant_id', 'status_text', 'trade_date', 'source_cycle_date', 'amount', 'batch_date'])}
      FROM s WHERE batch_date = '20240131'),
c AS (SELECT plan_number, client_id, participant_id, status_text, amount, batch_date,
      {_duck_date('trade_date')} AS trade_date, {_duck_date("coalesce(source_cycle_date, '2024-01-31')")} AS source_cycle_date FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY plan_number, participant_id ORDER BY batch_date ASC NULLS FIRST,
      client_id ASC NULLS FIRST, status_text ASC NULLS FIRST, amount ASC NULLS FIRST, trade_date ASC NULLS FIRST,
      source_cycle_date ASC NULLS FIRST) AS rn FROM c)
SELECT plan_number, client_id, participant_id, status_text, amount, batch_date, trade_date, source_cycle_date FROM r
WHERE rn = 1 AND NOT coalesce(plan_number BETWEEN '000001' AND '000040', false)
  AND NOT coalesce(client_id = 'NG' AND plan_number IN ('999999', '999998', '999997'), false)"""


@register("raw_load", _RAW_ORACLE)
def q_raw_load(spark, sf):
    staging = spark_sql(spark, sf, fd.STAGING_FEED, spread=True)
    base = scratch_path(spark, "raw")
    out = raw_load.staging_to_raw(spark, staging, _RAW_PARAMS, "20240131", base, audit_path=f"{base}/_audit")
    return spark.read.parquet(out["valid"])


@register("audit_counts", f"""SELECT 'SUCCESS' AS status, v.n + x.n AS record_count, v.n AS valid_count, x.n AS rejected_count
FROM (SELECT count(*) AS n FROM ({_RAW_ORACLE})) v, (SELECT count(*) - (SELECT count(*) FROM ({_RAW_ORACLE})) AS n FROM ({duck_sql(fd.STAGING_FEED)}) WHERE batch_date = '20240131') x""")
def q_audit_counts(spark, sf):
    base = scratch_path(spark, "raw")
    raw_load.staging_to_raw(spark, spark_sql(spark, sf, fd.STAGING_FEED, spread=True), _RAW_PARAMS, "20240131", base, audit_path=f"{base}/_audit")
    return writers.read_audit(spark, f"{base}/_audit").select("status", "record_count", "valid_count", "rejected_count")


@register("raw_rejected", _RAW_ORACLE.replace(
    "SELECT plan_number, client_id, participant_id, status_text, amount, batch_date, trade_date, source_cycle_date FROM r\nWHERE rn = 1 AND NOT",
    "SELECT plan_number, client_id, participant_id, status_text, amount, batch_date, trade_date, source_cycle_date FROM r\nWHERE rn > 1 OR") .replace(
    "AND NOT coalesce(client_id = 'NG'", "OR coalesce(client_id = 'NG'"))
def q_raw_rejected(spark, sf):
    staging = spark_sql(spark, sf, fd.STAGING_FEED, spread=True)
    base = scratch_path(spark, "raw")
    out = raw_load.staging_to_raw(spark, staging, _RAW_PARAMS, "20240131", base)
    return writers.read_partitioned(spark, out["rejected"], ["batch_date"]).drop("to_drop", "drop_record_remarks")


_TB_KEYS = ["client_id", "plan_number", "participant_id", "transfer_balance_seq_number"]
_TB_ORACLE = (f"WITH e AS ({_transfer_oracle(TRANSFER_JB, 'VRP-SP')} UNION ALL {_transfer_oracle(TRANSFER_NG, 'VRP-PB')}),\n"
              "r AS (SELECT *, row_number() OVER (PARTITION BY client_id, plan_number, participant_id, transfer_balance_seq_number"
              " ORDER BY source_cycle_date ASC NULLS FIRST, source_system ASC NULLS FIRST, source_month_end_date ASC NULLS FIRST,"
              " from_fund_id ASC NULLS FIRST, to_fund_id ASC NULLS FIRST, allocation_percent ASC NULLS FIRST, transfer_amount ASC NULLS FIRST,"
              " activity_type ASC NULLS FIRST, usage_code_1 ASC NULLS FIRST, usage_code_2 ASC NULLS FIRST, usage_code_3 ASC NULLS FIRST,"
              " usage_code_4 ASC NULLS FIRST, usage_code_5 ASC NULLS FIRST, reversal_run_date ASC NULLS FIRST,"
              " reversal_type_flag ASC NULLS FIRST) AS rn FROM e)\n"
              "SELECT coalesce(client_id, '-9999') AS client_id, coalesce(plan_number, '-9999') AS plan_number,"
              " coalesce(participant_id, '-9999') AS participant_id,"
              " coalesce(transfer_balance_seq_number, '-9999') AS transfer_balance_seq_number, source_cycle_date, source_system,"
              " source_month_end_date, from_fund_id, to_fund_id, allocation_percent, transfer_amount, activity_type, usage_code_1,"
              " usage_code_2, usage_code_3, usage_code_4, usage_code_5, reversal_run_date, reversal_type_flag FROM r WHERE rn = 1")


@register("transform_load", _TB_ORACLE)
def q_transform_load(spark, sf):
    base = scratch_path(spark, "transform")

    def build():
        return transfer_balance(spark_sql(spark, sf, TRANSFER_JB), spark_sql(spark, sf, TRANSFER_NG))

    out = transform_load.raw_to_transform(spark, build, "transfer_balance", _TB_KEYS, "full_load",
                                          f"{base}/tables", f"{base}/export", "20240131", audit_path=f"{base}/_audit")
    return for_compare(spark.read.parquet(out["export"]))


@register("id_rewrite", f"""WITH t AS ({duck_sql(ID_TARGET)}), m AS ({duck_sql(ID_CHANGES)} )
SELECT coalesce(m.new_participant_id, t.participant_id) AS participant_id, t.o_orderkey, t.o_orderstatus
FROM t LEFT JOIN (SELECT * FROM m WHERE admin_tran_code IN ('850', '851')) m ON t.participant_id = m.old_participant_id""")
def q_id_rewrite(spark, sf):
    base = scratch_path(spark, "idtable")
    writers.write_version(spark_sql(spark, sf, ID_TARGET), base)
    return spark.read.parquet(id_rewrite.apply_id_changes(spark, base, spark_sql(spark, sf, ID_CHANGES)))


# ---------------------------------------------------------------- T2/T3 ----
from ledgerflow.bindings import plan_binding  # noqa: E402

register("plan", plan_binding.oracle_sql())(plan_binding.q_plan)
register("plan_allocated", plan_binding.oracle_sql(allocated=True))(plan_binding.q_plan_allocated)

from ledgerflow.bindings import jobs  # noqa: E402

QUERIES.update(jobs.QUERIES)
ORACLES.update(jobs.ORACLES)

"""Job paths, table states and small steps bound to the supplied tables.

Each query runs the engine's own writers and jobs, over two loads where the
step is incremental, and reads back what they left; the oracle states that
end state in plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.bindings import feeds as fd
from ledgerflow.bindings.feeds import duck_sql, for_compare, spark_sql, table
from ledgerflow.functions import cleansing
from ledgerflow.operators import joins, merge, quality
from ledgerflow.plans import id_rewrite, raw_load, transform_load
from ledgerflow.session import scratch_path
from ledgerflow.sinks import buckets, writers
from ledgerflow.sources import catalog, files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str):
    def deco(fn):
        QUERIES[name], ORACLES[name] = fn, oracle
        return fn
    return deco


# ---- J14 on repeated and NULL keys -----------------------------------------------
@register("merge_frames_repeated", """WITH a AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_nationkey * 100 + c_custkey % 40 END AS k, c_custkey AS n,
    CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS v FROM customer),
  b AS (SELECT CASE WHEN s_suppkey % 20 = 0 THEN NULL ELSE s_nationkey * 100 + s_suppkey % 40 END AS k, s_suppkey AS n, s_name AS v,
    s_phone AS w FROM (SELECT *, 'p' || cast(s_suppkey AS varchar) AS s_phone FROM supplier)),
  a1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n, v NULLS FIRST) AS r FROM a WHERE k IS NOT NULL) WHERE r = 1),
  b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n, v NULLS FIRST, w NULLS FIRST) AS r FROM b WHERE k IS NOT NULL) WHERE r = 1)
SELECT coalesce(a1.k, b1.k) AS k, coalesce(a1.n, b1.n) AS n, coalesce(a1.v, b1.v) AS v, b1.w FROM a1 FULL JOIN b1 ON a1.k = b1.k
UNION ALL SELECT k, n, v, NULL FROM a WHERE k IS NULL UNION ALL SELECT k, n, v, w FROM b WHERE k IS NULL""")
def merge_frames_repeated(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    a = c.selectExpr("CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_nationkey * 100 + c_custkey % 40 END AS k", "c_custkey AS n",
                     "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS v")
    b = s.selectExpr("CASE WHEN s_suppkey % 20 = 0 THEN NULL ELSE s_nationkey * 100 + s_suppkey % 40 END AS k", "s_suppkey AS n", "s_name AS v",
                     "'p' || cast(s_suppkey AS string) AS w")
    return joins.merge_frames(a, b, ["k"])


# ---- partition values are kept as declared ------------------------------------------
_PADDED = """SELECT lpad(cast(o_custkey % 30 AS string), 6, '0') AS plan_number, o_orderkey, cast(o_totalprice AS decimal(15,2)) AS amount,
  'U' AS seq_oper_code FROM {orders}"""
# touches plans 0 to 9 only: plan 9 is emptied, a new plan appears
_PADDED_CHANGES = """SELECT CASE WHEN o_orderkey % 7 = 0 AND o_custkey % 30 < 9 THEN '000099' ELSE lpad(cast(o_custkey % 30 AS string), 6, '0') END AS plan_number,
  o_orderkey, cast(1 AS decimal(15,2)) AS amount, CASE WHEN o_custkey % 30 = 9 THEN 'D' ELSE 'U' END AS seq_oper_code
FROM {orders} WHERE o_custkey % 30 < 10"""


@register("partition_merge_padded", f"""WITH t AS ({duck_sql(_PADDED)}), s AS ({duck_sql(_PADDED_CHANGES)})
SELECT t.plan_number, t.o_orderkey, cast(CASE WHEN s.o_orderkey IS NULL THEN t.amount ELSE s.amount END AS double) AS amount
FROM t LEFT JOIN s ON t.plan_number = s.plan_number AND t.o_orderkey = s.o_orderkey WHERE coalesce(s.seq_oper_code, 'U') <> 'D'
UNION ALL SELECT plan_number, o_orderkey, cast(amount AS double) FROM s WHERE plan_number = '000099'""")
def partition_merge_padded(spark, sf):
    path = scratch_path(spark, "padded")
    writers.overwrite(spark_sql(spark, sf, _PADDED), path, ["plan_number"])
    spec = merge.upsert_spec(["plan_number", "o_orderkey"], delete_code_col="seq_oper_code")
    writers.merge_into_partitions(spark, path, spark_sql(spark, sf, _PADDED_CHANGES), spec, ["plan_number"])
    return for_compare(writers.read_partitioned(spark, path, ["plan_number"]).select("plan_number", "o_orderkey", "amount"))


# ---- K5 and K8 in hash buckets, K9 by a switch ------------------------------------------
_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, cast(1 AS bigint) AS lines, 'U' AS op FROM {orders}"
# orders with a returned line change; those with nothing but returned lines go
_RETURNS = """SELECT l_orderkey AS o_orderkey, max(l_suppkey) AS o_custkey, max(l_returnflag) AS o_orderstatus, count(*) AS lines,
  CASE WHEN min(l_returnflag) = 'R' THEN 'D' ELSE 'U' END AS op FROM {lineitem} GROUP BY l_orderkey HAVING max(l_returnflag) = 'R'"""


@register("merge_buckets", f"""WITH t AS ({duck_sql(_ORDERS)}), s AS ({duck_sql(_RETURNS)})
SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)
UNION ALL SELECT * FROM s WHERE op <> 'D' OR o_orderkey NOT IN (SELECT o_orderkey FROM t)""")
def merge_buckets(spark, sf):
    base = scratch_path(spark, "order-buckets")
    name, orders = f"ledger_{base.rsplit('-', 1)[1]}.orders", spark_sql(spark, sf, _ORDERS)
    buckets.create(spark, name, base, orders.schema, ["o_orderkey"], 64)
    buckets.merge_into_buckets(spark, name, orders, merge.upsert_spec(["o_orderkey"], "op"))
    buckets.merge_into_buckets(spark, name, spark_sql(spark, sf, _RETURNS), merge.upsert_spec(["o_orderkey"], "op"))
    return spark.table(name)


@register("rewrite_bucket_keys", "SELECT o_orderkey + CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 1000000000 ELSE 0 END AS o_orderkey, o_custkey FROM orders")
def rewrite_bucket_keys(spark, sf):
    base = scratch_path(spark, "key-buckets")
    name, orders = f"ledger_{base.rsplit('-', 1)[1]}.orders", table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    buckets.create(spark, name, base, orders.schema, ["o_orderkey"], 64)
    buckets.merge_into_buckets(spark, name, orders, merge.upsert_spec(["o_orderkey"]))
    moved = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("old"), (F.col("l_orderkey") + 1_000_000_000).alias("new")).distinct()
    buckets.rewrite_bucket_keys(spark, name, moved, "old", "new")
    return spark.table(name)


@register("table_switch", "SELECT o_orderkey, o_orderstatus FROM orders")
def table_switch(spark, sf):
    base, o = scratch_path(spark, "switch"), table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    name = f"ledger_{base.rsplit('-', 1)[1]}.orders"
    for rows in (o.where("o_orderstatus = 'F'"), o):  # the second version takes the first one's place in one statement
        writers.register_table(spark, name, writers.write_version(rows, base), rows.schema)
    return spark.table(name)


# ---- T7 over two loads, with id changes, in the catalog ------------------------------
# one batch per half; the second brings back a tenth of the first's keys with other values
_BATCHES = """SELECT lpad(cast(o_orderkey AS string), 9, '0') AS participant_id, '1' || lpad(cast(o_custkey AS string), 5, '0') AS plan_number,
  cast(o_orderkey AS string) AS amount, '20240131' AS batch_date FROM {orders} WHERE o_orderkey % 2 = 0
UNION ALL SELECT lpad(cast(o_orderkey AS string), 9, '0'), '1' || lpad(cast(o_custkey AS string), 5, '0'), 'second', '20240201'
FROM {orders} WHERE o_orderkey % 2 = 1 OR o_orderkey % 20 = 0"""
_CHANGES = """SELECT CASE o_orderkey % 3 WHEN 0 THEN '850' WHEN 1 THEN '851' ELSE '900' END AS admin_tran_code,
  lpad(cast(o_orderkey AS string), 9, '0') AS old_participant_id, 'N' || cast(o_orderkey AS string) AS new_participant_id
FROM {orders} WHERE o_orderkey % 5 = 0"""
_MERGED = f"""b AS ({duck_sql(_BATCHES)}),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY plan_number, participant_id ORDER BY batch_date DESC) AS r FROM b) WHERE r = 1)"""


def _raw_params(file_name: str, load: str) -> raw_load.FeedParams:
    return raw_load.FeedParams(id_rewrite.ID_REWRITE_SOURCE, file_name, "balances", load, ("plan_number", "participant_id"))


def _two_loads(spark, sf, params, database):
    base, staging = scratch_path(spark, "raw"), spark_sql(spark, sf, _BATCHES)
    for date in ("20240131", "20240201"):
        out = raw_load.staging_to_raw(spark, staging, params, date, base, database=database, keep_versions=2)
    return out


@register("raw_incremental", f"""WITH {_MERGED}, c AS ({duck_sql(_CHANGES)}),
once AS (SELECT old_participant_id, new_participant_id FROM c WHERE admin_tran_code IN ('850', '851'))
SELECT coalesce(once.new_participant_id, m.participant_id) AS participant_id, m.plan_number, m.amount, m.batch_date
FROM m LEFT JOIN once ON m.participant_id = once.old_participant_id""")
def raw_incremental(spark, sf):
    database = f"ledger_{scratch_path(spark, 'db').rsplit('-', 1)[1]}"
    changes = scratch_path(spark, "changes")
    spark_sql(spark, sf, _CHANGES).write.parquet(changes)
    writers.register_table(spark, f"{database}.{id_rewrite.CHANGE_TABLE.format(channel='NG')}", changes, spark.read.parquet(changes).schema)
    # the changes apply to what each load merged: ids of the first load are rewritten before the second arrives
    _two_loads(spark, sf, _raw_params("FEED.NG", "incremental"), None)
    base, staging = scratch_path(spark, "raw"), spark_sql(spark, sf, _BATCHES)
    params = _raw_params("FEED.NG", "incremental")
    raw_load.staging_to_raw(spark, staging, params, "20240131", base)
    raw_load.staging_to_raw(spark, staging, params, "20240201", base, database=database, keep_versions=2)
    return spark.table(f"{database}.balances")


@register("raw_incremental_buckets", f"""WITH {_MERGED}, c AS ({duck_sql(_CHANGES)}),
once AS (SELECT old_participant_id, new_participant_id FROM c WHERE admin_tran_code IN ('850', '851'))
SELECT coalesce(once.new_participant_id, m.participant_id) AS participant_id, m.plan_number, m.amount, m.batch_date
FROM m LEFT JOIN once ON m.participant_id = once.old_participant_id""")
def raw_incremental_buckets(spark, sf):
    database = f"ledger_{scratch_path(spark, 'db').rsplit('-', 1)[1]}"
    changes, base, staging = scratch_path(spark, "changes"), scratch_path(spark, "raw"), spark_sql(spark, sf, _BATCHES)
    params = _raw_params("FEED.NG", "incremental")
    raw_load.staging_to_raw(spark, staging, params, "20240131", base, database=database, bucketed=("participant_id", 32))
    spark_sql(spark, sf, _CHANGES).write.parquet(changes)
    writers.register_table(spark, f"{database}.{id_rewrite.CHANGE_TABLE.format(channel='NG')}", changes, spark.read.parquet(changes).schema)
    out = raw_load.staging_to_raw(spark, staging, params, "20240201", base, database=database, bucketed=("participant_id", 32))
    return spark.table(out["valid"])


@register("raw_seqhist", f"WITH {_MERGED} SELECT participant_id, plan_number, amount, batch_date FROM m")
def raw_seqhist(spark, sf):
    params = raw_load.FeedParams(id_rewrite.ID_REWRITE_SOURCE, "FEED_SEQHIST.NG", "balances", "full_load", ("plan_number", "participant_id"),
                                 rules=raw_load.FeedRules(seqhist=True))
    return writers.read_declared(spark, _two_loads(spark, sf, params, None)["valid"])


# ---- T8 over two loads -----------------------------------------------------------------
_CYCLES = """SELECT cast(o_orderkey AS string) AS plan_number, cast({year} AS string) || '-0' || cast(o_orderkey % 3 + 1 AS string) || '-01' AS source_cycle_date,
  {value} AS status FROM {{orders}} WHERE {where}"""
_CYCLE_1 = _CYCLES.format(year=2023, value="o_orderstatus", where="o_orderkey % 2 = 0")
_CYCLE_2 = _CYCLES.format(year="CASE WHEN o_orderkey % 8 = 0 THEN 2023 ELSE 2024 END", value="' new '", where="o_orderkey % 4 = 0 OR o_orderkey % 2 = 1")


def _transformed(spark, sf, entity: str, keys: list[str], loads: list[str], bucketed: int | None = None) -> dict[str, str]:
    base = scratch_path(spark, "transform")
    database = f"ledger_{base.rsplit('-', 1)[1]}"
    for sql in loads:
        out = transform_load.raw_to_transform(spark, lambda sql=sql: spark_sql(spark, sf, sql), entity, keys, "incremental",
                                              f"{base}/tables", f"{base}/export", "20240131", database=database, keep_versions=2, bucketed=bucketed)
    return out | {"name": f"{database}.{entity}"}


@register("transform_incremental", f"""WITH a AS ({duck_sql(_CYCLE_1)}), b AS ({duck_sql(_CYCLE_2)})
SELECT plan_number, source_cycle_date, trim(status) AS status FROM b
UNION ALL SELECT plan_number, source_cycle_date, status FROM a WHERE plan_number NOT IN (SELECT plan_number FROM b)""")
def transform_incremental(spark, sf):
    return spark.table(_transformed(spark, sf, "plan_status", ["plan_number"], [_CYCLE_1, _CYCLE_2])["name"])


@register("transform_incremental_by_cycle", f"""WITH a AS ({duck_sql(_CYCLE_1)}), b AS ({duck_sql(_CYCLE_2)})
SELECT plan_number, source_cycle_date, trim(status) AS status FROM b
UNION ALL SELECT plan_number, source_cycle_date, status FROM a
WHERE plan_number || source_cycle_date NOT IN (SELECT plan_number || source_cycle_date FROM b)""")
def transform_incremental_by_cycle(spark, sf):
    out = _transformed(spark, sf, "plan_status", ["plan_number", "source_cycle_date"], [_CYCLE_1, _CYCLE_2])
    return writers.read_declared(spark, out["table"])


@register("transform_incremental_buckets", f"""WITH a AS ({duck_sql(_CYCLE_1)}), b AS ({duck_sql(_CYCLE_2)})
SELECT plan_number, source_cycle_date, trim(status) AS status FROM b
UNION ALL SELECT plan_number, source_cycle_date, status FROM a WHERE plan_number NOT IN (SELECT plan_number FROM b)""")
def transform_incremental_buckets(spark, sf):
    return spark.table(_transformed(spark, sf, "plan_status", ["plan_number"], [_CYCLE_1, _CYCLE_2], bucketed=32)["table"])


_TXN_ROWS = """SELECT {key} AS participant_id, cast(date_trunc('year', o_orderdate) AS date) AS run_date, {amount} AS amount, {code} AS seq_oper_code
FROM {{orders}}"""
# the second load brings all orders again, two thirds of them under keys of their own
_TXN_1 = _TXN_ROWS.format(key="cast(o_orderkey AS string)", amount="cast(o_custkey AS string)", code="'A'")
_TXN_2 = _TXN_ROWS.format(key="CASE WHEN o_orderkey % 3 > 0 THEN 'N' ELSE '' END || cast(o_orderkey AS string)", amount="'0'",
                          code="CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'C' END")


@register("transform_txn", f"""WITH a AS ({duck_sql(_TXN_1)}), b AS ({duck_sql(_TXN_2)})
SELECT b.participant_id, cast(b.run_date AS varchar) AS run_date, b.amount, b.seq_oper_code FROM b
WHERE b.seq_oper_code <> 'D' OR b.participant_id NOT IN (SELECT participant_id FROM a)
UNION ALL SELECT participant_id, cast(run_date AS varchar), amount, seq_oper_code FROM a WHERE participant_id NOT IN (SELECT participant_id FROM b)""")
def transform_txn(spark, sf):
    out = _transformed(spark, sf, transform_load.TXN_ENTITY, ["participant_id", "run_date"], [_TXN_1, _TXN_2])
    return for_compare(writers.read_declared(spark, out["table"]))


# ---- K3, K9, K10, S6, S7, C7, C8, C13, C14, C17, Q6 --------------------------------------
@register("append", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def append(spark, sf):
    o, path = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), scratch_path(spark, "append")
    writers.overwrite(o, path, ["o_orderstatus"])
    writers.append(o.where("o_orderstatus = 'F'"), path, ["o_orderstatus"])
    return writers.read_partitioned(spark, path, ["o_orderstatus"])


@register("create_if_missing", "SELECT o_orderkey, lpad(cast(o_custkey AS varchar), 8, '0') AS plan FROM orders")
def create_if_missing(spark, sf):
    base, o = scratch_path(spark, "created"), table(spark, sf, "orders").selectExpr("o_orderkey", "lpad(cast(o_custkey AS string), 8, '0') AS plan")
    writers.create_if_missing(spark, base, o.schema, ["plan"])
    writers.create_if_missing(spark, base, "other int")  # there already: nothing happens
    writers.merge_into(spark, base, o, merge.upsert_spec(["o_orderkey"]))
    return writers.read_current(spark, base)


@register("audit", """SELECT 'tpch' AS source_name, 'orders' AS file_name, o_orderpriority AS batch_date, 'orders_raw' AS table_name,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'FAILED' ELSE 'SUCCESS' END AS status, 'SYSTEM' AS created_by FROM (SELECT DISTINCT o_orderpriority FROM orders)""")
def audit(spark, sf):
    path = scratch_path(spark, "audit")
    for row in table(spark, sf, "orders").select("o_orderpriority").distinct().collect():
        batch = row[0]

        def job(batch=batch):
            if batch.startswith("1"):
                raise ValueError("a failing batch")

        try:
            writers.run_with_audit(spark, path, job, source_name="tpch", file_name="orders", batch_date=batch, table_name="orders_raw")
        except ValueError:
            pass  # the audit row is what is asked for
    return spark.read.parquet(path).select("source_name", "file_name", "batch_date", "table_name", "status", "created_by")


@register("catalog_scan", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '5-LOW')")
def catalog_scan(spark, sf):
    path = scratch_path(spark, "catalog")
    name = f"ledger_{path.rsplit('-', 1)[1]}.orders"
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    writers.overwrite(o, path, ["o_orderstatus"])
    writers.register_table(spark, name, path, o.schema, ["o_orderstatus"])
    found = catalog.read_table(spark, name, {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "5-LOW"]})
    return found.select("o_orderkey", "o_orderpriority")


@register("segments_and_stamps", """SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_orderstatus, 'segment_' || o_orderstatus AS segment,
  '20240131' AS batch_date, 'whole' AS file_segment FROM orders""")
def segments_and_stamps(spark, sf):
    path = scratch_path(spark, "segments")
    o = table(spark, sf, "orders").selectExpr("cast(o_orderkey AS string) AS o_orderkey", "o_orderstatus", "o_orderstatus AS segment")
    o.write.partitionBy("segment").option("header", "true").option("delimiter", "|").csv(path)
    # folder names stand for segment names, which differ from run to run
    df = files.read_delimited(spark, f"{path}/*/part-*", "o_orderkey string, o_orderstatus string", with_file_name=True)
    names = files.list_segments(df)
    known = df.join(names, "file_segment", "left_semi")
    stamped = files.stamp_file_segment(files.stamp_batch_date(known.drop("file_segment"), "20240131"), "whole")
    return stamped.select("o_orderkey", "o_orderstatus", F.concat(F.lit("segment_"), F.col("o_orderstatus")).alias("segment"), "batch_date", "file_segment")


_UNTIDY = """SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '  ' || o_orderstatus || ' ' END AS status, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS cust,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE cast(o_orderdate AS date) END AS day, o_orderkey,
  CASE WHEN o_orderkey % 11 = 0 THEN 'D' WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'A' END AS seq_oper_code FROM {orders}"""


@register("tidy_keys", f"""SELECT coalesce(trim(status), '-9999') AS status, coalesce(cust, -9999) AS cust, cast(coalesce(day, DATE '2024-02-01') AS varchar) AS day,
  o_orderkey, seq_oper_code, CASE WHEN seq_oper_code = 'D' THEN 'D' ELSE 'U' END AS delta_op FROM ({duck_sql(_UNTIDY)})""")
def tidy_keys(spark, sf):
    df = cleansing.trim_string_columns(spark_sql(spark, sf, _UNTIDY))
    df = cleansing.stub_null_keys(df, ["status", "cust", "day"], F.lit("2024-02-01").cast("date"))
    return for_compare(cleansing.add_operation_column(df))


@register("record_counts", "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer")
def record_counts(spark, sf):
    counts = [(name, quality.record_count(table(spark, sf, name))) for name in ("orders", "customer")]
    return spark.createDataFrame(counts, "name string, n long")

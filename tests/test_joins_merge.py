import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators import aggregates, joins, merge
from frame_rows import rows

CODES = ["035", "100", "851"]
USAGE = [None, "1", "3", "8", "9", "O", "R", "WR", "0"]
ACT = [None, "1", "2", "x"]
TXN_SCHEMA = ("id int, base_transaction_code string, activity_type string, usage_code_1 string, usage_code_2 string, "
              "usage_code_3 string, usage_code_4 string, usage_code_5 string, standard_usage_code_4 string")
TYPE_COLS = ["usage_code_1", "usage_code_2", "usage_code_3", "usage_code_4", "usage_code_5", "standard_usage_code_1",
             "standard_usage_code_2", "standard_usage_code_3", "standard_usage_code_4", "standard_usage_code_5"]
TYPE_SCHEMA = "tid int, base_transaction_code string, activity_type string, " + ", ".join(f"{c} string" for c in TYPE_COLS)


def _case_join(spark, t, tt):
    t.createOrReplaceTempView("t_rules")
    tt.createOrReplaceTempView("tt_rules")
    act = "coalesce(try_cast({x}.activity_type AS int), -9999)"
    rule0 = ", ".join(f"'{c}'" for c in joins.RULE0_CODES)
    whens = "".join(
        f" WHEN t.{c} IN ({', '.join(repr(v) for v in vals)}) THEN t.{c} = tt.{c} AND t.base_transaction_code = tt.base_transaction_code"
        f" AND {act.format(x='t')} = {act.format(x='tt')}" for c, vals in joins.RULES)
    allnull = " AND ".join(f"tt.{c} IS NULL" for c in TYPE_COLS)
    on = (f"CASE WHEN t.base_transaction_code IN ({rule0}) THEN t.base_transaction_code = tt.base_transaction_code{whens}"
          f" ELSE CASE WHEN {allnull} THEN t.base_transaction_code = tt.base_transaction_code AND {act.format(x='t')} = {act.format(x='tt')} END END")
    return spark.sql(f"SELECT t.id, tt.tid FROM t_rules t LEFT JOIN tt_rules tt ON {on}")


txn_row = st.tuples(st.sampled_from(CODES), st.sampled_from(ACT), *[st.sampled_from(USAGE)] * 6)
type_row = st.tuples(st.sampled_from(CODES), st.sampled_from(ACT), *[st.sampled_from(USAGE)] * 10)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(txn_row, min_size=1, max_size=25), st.lists(type_row, min_size=1, max_size=25))
def test_rule_join_equals_case_join(spark, txns, types):
    t = spark.createDataFrame([(i, *r) for i, r in enumerate(txns)], TXN_SCHEMA)
    tt = spark.createDataFrame([(i, *r) for i, r in enumerate(types)], TYPE_SCHEMA)
    got = joins.rule_join(t, tt, how="left").select("id", F.col("tt_tid").alias("tid"))
    assert rows(got) == rows(_case_join(spark, t, tt))


def test_rule_join_plan_has_no_nested_loop(spark):
    t = spark.createDataFrame([(1, "035", "1", None, None, None, None, None, None)], TXN_SCHEMA)
    tt = spark.createDataFrame([(1, "035", "1", *[None] * 10)], TYPE_SCHEMA)
    plan = joins.rule_join(t, tt)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "HashJoin" in plan


def test_sentinel_join_and_prefix(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, "n"), ("x", "y"), ("-9999", "s")], "k2 string, w string")
    got = rows(a.join(b, joins.sentinel_on(a, b, [("k", "k2")]), "left").select("v", "w"))
    assert got == [(1, "n"), (1, "s"), (2, "y")]
    assert spark.range(1).select(joins.prefix(F.lit("123456789012345"))).first()[0] == "1234567890123"


def test_keep_latest_batches_distinct_first(spark):
    df = spark.createDataFrame([("3",), ("3",), ("2",), ("1",)], "batch_date string")
    assert rows(joins.keep_latest_batches(df)) == [("2",), ("3",), ("3",)]
    assert rows(joins.keep_latest_batches(df, distinct=False)) == [("3",), ("3",)]


def test_merge_frames_precedence(spark):
    a = spark.createDataFrame([(1, None, "a"), (2, "b", None)], "k int, x string, only_a string")
    b = spark.createDataFrame([(1, "B1", 9), (3, "B3", 8)], "k int, x string, only_b int")
    assert rows(joins.merge_frames(a, b, ["k"])) == [(1, "B1", "a", 9), (2, "b", None, None), (3, "B3", None, 8)]
    assert rows(joins.merge_frames(a, b, ["k"], prefer="right"))[1] == (2, "b", None, None)


def test_allocation_flag_shapes(spark):
    df = spark.createDataFrame([(1, "alloc "), (1, "ALOC"), (2, "ALLOC"), (2, "X"), (3, None)], "k int, a string")
    s = aggregates.allocation_summary(df, ["k"], "a")
    plan = s.select("k", aggregates.unallocated_flag(F.col("_acct_n"), F.col("_acct_min"), F.col("_acct_max")).alias("f"))
    div = s.select("k", aggregates.unallocated_flag(F.col("_acct_n"), F.col("_acct_min"), F.col("_acct_max"), True).alias("f"))
    assert rows(plan) == [(1, "N"), (2, "Y"), (3, "Y")]
    assert rows(div) == [(1, "N"), (2, "Y"), (3, None)]


TARGET = "k int, v string, op string"


def test_merge_delete_update_insert_fixture(spark):
    target = spark.createDataFrame([(1, "t1", None), (2, "t2", None), (3, "t3", None), (None, "tn", None)], TARGET)
    source = spark.createDataFrame([(2, "s2", "U"), (3, "s3", "D"), (4, "s4", "U"), (5, "s5", "D"), (None, "sn", "U"),
                                    (1, "s1", None)], TARGET)
    out = merge.merge_frame(target, source, merge.upsert_spec(["k"], delete_code_col="op"))
    assert rows(out) == [(None, "sn", "U"), (None, "tn", None), (1, "s1", None), (2, "s2", "U"), (4, "s4", "U"), (5, "s5", "D")]


def test_merge_duplicate_source_raises_and_clause_order(spark):
    target = spark.createDataFrame([(1, "t1", None)], TARGET)
    source = spark.createDataFrame([(1, "a", "U"), (1, "b", "U")], TARGET)
    with pytest.raises(ValueError):
        merge.merge_frame(target, source, merge.upsert_spec(["k"]))
    with pytest.raises(ValueError):
        merge.MergeSpec([("k", "k")], (merge.Clause("update"), merge.Clause("delete")))


def test_key_rewrite_and_ambiguity(spark):
    target = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "participant_id string, n int")
    changes = spark.createDataFrame([("A", "B"), ("B", "C")], "old_participant_id string, new_participant_id string")
    assert rows(merge.rewrite_keys(target, changes)) == [("B", 1), ("C", 2), ("C", 3)]  # one hop only
    assert rows(merge.merge_frame(target, changes, merge.key_rewrite_spec())) == [("B", 1), ("C", 2), ("C", 3)]
    bad = spark.createDataFrame([("A", "B"), ("A", "C")], "old_participant_id string, new_participant_id string")
    with pytest.raises(ValueError):
        merge.rewrite_keys(target, bad)


def test_broadcast_if_small_checks_rows_and_bytes(spark):
    df = spark.range(100).select(F.col("id"), F.lit("x" * 100).alias("pad"))
    plan = lambda d: spark.range(5).join(d, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan(joins.broadcast_if_small(df))
    assert joins.broadcast_if_small(df, max_rows=10) is df
    assert joins.broadcast_if_small(df, max_bytes=1000) is df


def test_operation_column(spark):
    from ledgerflow.functions import cleansing
    df = spark.createDataFrame([("D",), ("A",), (None,)], "seq_oper_code string")
    assert sorted(r.delta_op for r in cleansing.add_operation_column(df).collect()) == ["D", "U", "U"]


def test_duplicate_source_keys_without_target_match_are_inserted(spark):
    target = spark.createDataFrame([(1, "t1", None)], TARGET)
    source = spark.createDataFrame([(5, "a", "U"), (5, "b", "U")], TARGET)
    out = merge.merge_frame(target, source, merge.upsert_spec(["k"]))
    assert rows(out) == [(1, "t1", None), (5, "a", "U"), (5, "b", "U")]

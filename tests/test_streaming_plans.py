import os
import tempfile

from ledgerflow.plans import raw_load
from ledgerflow.session import scratch_path
from ledgerflow.sinks import writers
from ledgerflow.streaming import run_landed_feeds


def test_landed_feeds_stream_runs_raw_job(spark):
    land = tempfile.mkdtemp(prefix="lf-land-")
    os.makedirs(f"{land}/20240131/src/feed")
    with open(f"{land}/20240131/src/feed/segment1.psv", "w") as fh:
        fh.write("Plan_Number|Participant_Id|Trade_Date\n000050|1|01/02/2024\n000050|1|01/02/2024\n000003|2|\n")
    params = raw_load.FeedParams("src", "SUPER_OMNI_X", "feed_raw", primary_keys=("plan_number", "participant_id"))
    raw = scratch_path(spark, "stream-raw")
    run_landed_feeds(spark, f"{land}/*/src/feed/", "Plan_Number string, Participant_Id string, Trade_Date string",
                     params, raw, query_name="t_landed")
    valid = writers.read_current(spark, f"{raw}/src/feed_raw").collect()
    assert [(r.plan_number, r.participant_id, r.trade_date) for r in valid] == [("000050", "1", "2024-01-02")]
    rejected = writers.read_partitioned(spark, f"{raw}/src/feed_raw_rejected", ["batch_date"])
    assert sorted(r.drop_record_remarks for r in rejected.collect()) == ["duplicate record", "invalid plan id"]


def test_rules_for_file_names():
    r = raw_load.rules_for_file("SUPER_OMNI_NEWR_SEQHIST")
    assert r.seqhist and r.txn_amounts and r.flag_plan_ids and not r.unique_key
    assert raw_load.rules_for_file("TRANSACTION_VNQ_WC.TXT").unique_key
    assert not raw_load.rules_for_file("TRANSACTION_VNQ_WC").unique_key  # equality, not substring (D10)
    assert raw_load.rules_for_file("EXN.XXEWRE01.XXEWRPFD.JB").fund_remap_target == "price_id"


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_transform_txn_merges_by_run_date_partition(spark):
    from ledgerflow.plans import transform_load

    base = scratch_path(spark, "tx")
    schema = "participant_id string, run_date date, amount string, seq_oper_code string"

    def load(data):
        return transform_load.raw_to_transform(
            spark, lambda: spark.createDataFrame(data, schema), "txn", ["participant_id", "run_date"], "full_load",
            f"{base}/t", f"{base}/x", "20240101")

    import datetime as dt
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    load([(" p1 ", d1, "10", "A"), ("p2", d1, "", "A"), ("p3", d2, "30", "A"), (None, d2, "5", "A")])
    out = load([("p1", d1, "11", "A"), ("p2", d1, "20", "D"), ("p4", d2, "40", "D")])
    got = sorted((r.participant_id, str(r.run_date), r.amount, r.seq_oper_code) for r in spark.read.parquet(out["export"]).collect())
    # p1 updated (trimmed key matched), p2 deleted, p4 unmatched delete inserted (D3), p3 and the stubbed key kept
    assert got == [("-9999", "2024-01-02", "5", "A"), ("p1", "2024-01-01", "11", "A"), ("p3", "2024-01-02", "30", "A"),
                   ("p4", "2024-01-02", "40", "D")]


def test_incremental_raw_load_with_id_changes(spark):
    params = raw_load.FeedParams("omni", "PLAN_NG", "plan_raw", file_load="incremental",
                                 primary_keys=("participant_id", "plan_number"), rules=raw_load.FeedRules())
    raw = scratch_path(spark, "inc")
    schema = "participant_id string, plan_number string, v string, batch_date string"
    day1 = spark.createDataFrame([("A", "100", "x", "20240101"), ("B", "100", "y", "20240101")], schema)
    day2 = spark.createDataFrame([("B", "100", "y2", "20240102"), ("C", "100", "z", "20240102")], schema)
    changes = spark.createDataFrame([("850", "A", "A2"), ("999", "C", "C9")],
                                    "admin_tran_code string, old_participant_id string, new_participant_id string")
    raw_load.staging_to_raw(spark, day1, params, "20240101", raw)
    out = raw_load.staging_to_raw(spark, day2, params, "20240102", raw, id_changes=changes)
    got = sorted((r.participant_id, r.v) for r in spark.read.parquet(out["valid"]).collect())
    assert got == [("A2", "x"), ("B", "y2"), ("C", "z")]


def test_txn_compat_switches(spark):
    from ledgerflow.bindings.registry import _txn_inputs
    from ledgerflow.plans.entities import txn as T

    ng, jb, types = _txn_inputs(spark, "/root/testdata/sf0.001")
    strict = T.txn(ng, jb, types)
    compat = T.txn(ng, jb, types, compat=True)
    assert "rank" not in strict.columns and compat.columns[-1] == "rank"
    assert compat.where("rank <> 1").count() == 0
    assert strict.count() > 0


def test_id_changes_gating(spark):
    from ledgerflow.plans import id_rewrite

    path = scratch_path(spark, "ssn")
    changes = spark.createDataFrame([("850", "A", "A2"), ("999", "B", "B2")],
                                    "admin_tran_code string, old_participant_id string, new_participant_id string")
    writers.overwrite_table(changes, "lf_raw_db.ssn_output_NG", path=path)
    got = id_rewrite.id_changes_for(spark, "omni_7.4", "PLAN_NG.DAT", "incremental", "lf_raw_db")
    assert [r.old_participant_id for r in got.collect()] == ["A"]
    assert id_rewrite.id_changes_for(spark, "other", "PLAN_NG.DAT", "incremental", "lf_raw_db") is None
    assert id_rewrite.id_changes_for(spark, "omni_7.4", "PLAN_JB.DAT", "incremental", "lf_raw_db") is None  # no table
    assert id_rewrite.id_changes_for(spark, "omni_7.4", "SEQHIST_NG", "incremental", "lf_raw_db") is None
    assert id_rewrite.id_changes_for(spark, "omni_7.4", "PLAN.DAT", "incremental", "lf_raw_db") is None

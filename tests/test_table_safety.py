"""Tables under failed writes, text partitions, retention, and jobs over several loads."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from frame_rows import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators.joins import merge_frames
from ledgerflow.operators.merge import MergeSpec, merge_frame, upsert_spec
from ledgerflow.plans import raw_load
from ledgerflow.plans.entities.producer_balance import producer_balance
from ledgerflow.session import scratch_path
from ledgerflow.sinks import writers
from ledgerflow.streaming import run_landed_feeds


def test_a_failed_write_does_not_block_the_table(spark):
    base = scratch_path(spark, "failing")
    writers.write_version(spark.createDataFrame([("000001", 1)], "k string, n int"), base, ["k"])
    bad = spark.range(3).select(F.lit("x").alias("k"), F.expr("cast(raise_error('stop') AS int)").alias("n"))
    with pytest.raises(Exception, match="stop"):
        writers.write_version(bad, base, ["k"])
    assert rows(writers.read_current(spark, base)) == [("000001", 1)]
    path = writers.merge_into(spark, base, spark.createDataFrame([("000001", 2), ("000002", 3)], "k string, n int"), upsert_spec(["k"]), ["k"])
    assert path.endswith("v000003") and rows(writers.read_current(spark, base)) == [("000001", 2), ("000002", 3)]


def test_keys_are_required(spark):
    with pytest.raises(ValueError, match="key"):
        upsert_spec([])
    with pytest.raises(ValueError, match="key"):
        MergeSpec([])
    params = raw_load.FeedParams("s", "f", "t", "incremental")
    with pytest.raises(ValueError, match="primary keys"):
        raw_load.staging_to_raw(spark, spark.createDataFrame([], "a string, batch_date string"), params, "20240101", "/nowhere")


def test_text_partitions_survive_a_merge_and_others_are_not_read(spark):
    path = scratch_path(spark, "padded")
    data = [("000001", 1, "a"), ("000002", 2, "b"), ("000010", 3, "c")]
    schema = "plan string, id int, v string"
    writers.overwrite(spark.createDataFrame(data, schema), path, ["plan"])
    other = os.path.join(path.removeprefix("file:"), "plan=000010")
    before = {f: os.stat(os.path.join(other, f)).st_mtime_ns for f in os.listdir(other)}
    source = spark.createDataFrame([("000001", 1, "new"), ("000002", 2, "gone"), ("1", 9, "one")], schema)
    spec = upsert_spec(["plan", "id"], delete_code_col="v", delete_code="gone")
    writers.merge_into_partitions(spark, path, source, spec, ["plan"])
    assert rows(writers.read_partitioned(spark, path, ["plan"]).select("plan", "id", "v")) == [("000001", 1, "new"), ("000010", 3, "c"), ("1", 9, "one")]
    assert before == {f: os.stat(os.path.join(other, f)).st_mtime_ns for f in os.listdir(other)}
    pruned = writers.read_declared(spark, path, {"plan": source.schema["plan"].dataType}).where(writers.partition_filter(["plan"], [("000001",), (None,)]))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "000001" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_versions_are_pruned_and_partitions_of_empty_tables_kept(spark):
    base = scratch_path(spark, "kept")
    writers.create_if_missing(spark, base, "k string, day date", ["day"])
    assert writers.read_current(spark, base).schema.simpleString() == "struct<k:string,day:date>"
    for n in range(4):
        writers.write_version(spark.createDataFrame([(str(n), dt.date(2024, 1, 1))], "k string, day date"), base, ["day"], keep=2)
    assert sorted(writers._version_folders(spark, base)) == ["v000004", "v000005"]
    assert rows(writers.read_current(spark, base)) == [("3", dt.date(2024, 1, 1))]
    with pytest.raises(ValueError):
        writers.prune_versions(spark, base, 0)


def test_merge_frames_takes_whole_rows(spark):
    left = spark.createDataFrame([("p1", "x", "2"), ("p1", "y", "1"), (None, "n", "3"), (None, "n", "3")], "k string, a string, b string")
    right = spark.createDataFrame([("p1", None, "z"), ("p2", "q", None)], "k string, a string, b string")
    assert rows(merge_frames(left, right, ["k"])) == [(None, "n", "3"), (None, "n", "3"), ("p1", "x", "2"), ("p2", "q", None)]
    assert rows(merge_frames(left, right, ["k"], prefer="right"))[2] == ("p1", "x", "z")
    with pytest.raises(Exception, match="several rows"):
        merge_frames(left, right, ["k"], repeated="error").collect()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, 5, 6]), st.sampled_from([None, 7])), max_size=8),
       st.lists(st.tuples(st.sampled_from([None, 1, 2, 4]), st.sampled_from([None, 8])), max_size=8))
def test_merge_frames_model(spark, a, b):
    def first(data):
        out = {}
        for row in sorted((r for r in data if r[0] is not None), key=lambda r: [(x is not None, x or 0) for x in r]):
            out.setdefault(row[0], row)
        return out

    fa, fb = first(a), first([(k, None, w) for k, w in b])
    want = [r for r in a if r[0] is None] + [(None, None, w) for k, w in b if k is None]
    for k in fa.keys() | fb.keys():
        x, y = fa.get(k, (k, None, None)), fb.get(k, (k, None, None))
        want.append((k, x[1], x[2] if x[2] is not None else y[2]))
    got = merge_frames(spark.createDataFrame(a, "k int, v int, w int"), spark.createDataFrame(b, "k int, w int"), ["k"])
    key = lambda r: [(x is not None, x or 0) for x in r]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_producer_balance_reads_text(spark):
    producer = spark.createDataFrame([("t", "", "RIA/IAR", "0000000000001", "p")], "rep_tax_id_ssn string, producer_role_code_desc string, producer_role_type string, participant_id string, plan_number string")
    core = spark.createDataFrame([("000000000000100", "p", None, "7.75", "n/a", None, "EE"), ("000000000000100", "p", "bad", "", "1.25", "x", "ER")], "participant_id string, plan_number string, source_cycle_date string, cash_value_amount string, sdba_cash_value_amount string, ytd_contributions string, money_type_description string")
    loans = spark.createDataFrame([("p", "0000000000001L", "PREMIER", "3.5", "")], "plan_number string, participant_id string, source_system string, outstanding_principal_balance string, loan_balance string")
    life = spark.createDataFrame([("p", "0000000000001X", "oops", "2024-01-01"), ("p", "0000000000002X", "4", "2024-01-01")], "plan_number string, participant_id string, cash_value_amt string, valuation_date string")
    row = producer_balance(producer, core, loans, life, as_of="2024-02-01").first()
    assert (str(row["core_cash_value_amount"]), str(row["loan_cash_value_amount"]), str(row["noncore_cash_value_amount"])) == ("7.75", "3.50", "4.75")
    assert row["source_cycle_date"] == dt.date(2024, 1, 31)
    assert producer_balance(producer, core, loans, life, strict_life_join=False, as_of="2024-02-01").count() == 2  # life by plan alone


def test_segments_of_one_date_in_two_runs(spark):
    land, raw = tempfile.mkdtemp(prefix="lf-land-"), scratch_path(spark, "stream-raw")
    params = raw_load.FeedParams("src", "SUPER_OMNI_X", "feed_raw", primary_keys=("plan_number", "participant_id"))

    def drop(date, name, body):
        os.makedirs(f"{land}/{date}/src/feed", exist_ok=True)
        with open(f"{land}/{date}/src/feed/{name}.psv", "w") as f:
            f.write("Plan_Number|Participant_Id\n" + body)
        run_landed_feeds(spark, f"{land}/*/src/feed/", "Plan_Number string, Participant_Id string", params, raw, query_name="t_two_runs")
        return sorted(r.participant_id for r in writers.read_current(spark, f"{raw}/src/feed_raw").collect())

    assert drop("20240131", "segment1", "000050|1\n000050|2\n") == ["1", "2"]
    assert drop("20240131", "segment2", "000050|3\n") == ["1", "2", "3"]
    assert drop("20240201", "segment1", "000050|4\n") == ["4"]
    assert drop("20240131", "segment3", "000050|5\n") == ["4"]  # an older date does not replace the newer one


def test_merge_keeps_rows_a_source_does_not_name(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert rows(merge_frame(t, t.limit(0), upsert_spec(["k"]))) == [(1, "a"), (2, "b")]

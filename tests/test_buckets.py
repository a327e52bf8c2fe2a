"""Bucketed tables: what a merge touches, and what readers see between its steps."""

from __future__ import annotations

import glob
import os
import uuid

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from ledgerflow.operators.merge import Clause, MergeSpec, key_pairs, merge_frame, upsert_spec
from ledgerflow.session import scratch_path
from ledgerflow.sinks import buckets


@pytest.fixture
def accounts(spark):
    """1,000 accounts in 16 buckets, loaded by a merge into an empty table."""
    name = f"bk_{uuid.uuid4().hex[:8]}.accounts"
    base = scratch_path(spark, "buckets")
    buckets.create(spark, name, base, "id string, plan int, amount decimal(10,2), op string", ["id"], 16)
    first = spark.range(1000).selectExpr("cast(id as string) as id", "cast(id % 7 as int) as plan", "cast(id as decimal(10,2)) as amount", "'U' as op")
    buckets.merge_into_buckets(spark, name, first, upsert_spec(["id"], "op"))
    return name, base.removeprefix("file:")


def files(base):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{base}/*/*/*.parquet")}


def changed(spark, ids, op="U"):
    return spark.createDataFrame([(i, 9, 1.0, op) for i in ids], "id string, plan int, amount double, op string")


def test_a_small_source_reads_and_writes_its_buckets_only(spark, accounts):
    name, base = accounts
    before, table = files(base), buckets.describe(spark, name)
    source = changed(spark, ["1", "2", "none"])
    schema = spark.table(name).schema
    hit = buckets.touched_buckets(table, schema, [(source, ["id"])])
    assert 1 <= len(hit) <= 3
    plan = buckets.target_rows(spark, table, hit)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and all(str(b) in plan.split("PartitionFilters")[1] for b in hit)
    read = {r[0] for r in buckets.target_rows(spark, table, hit).select(F.input_file_name()).distinct().collect()}
    assert len({p.split("_bucket=")[1].split("/")[0] for p in read}) <= len(hit)
    want = rows(merge_frame(spark.table(name), source, upsert_spec(["id"], "op")))
    after = buckets.merge_into_buckets(spark, name, source, upsert_spec(["id"], "op"))
    assert rows(spark.table(name)) == want and spark.table(name).count() == 1001
    assert {p: t for p, t in files(base).items() if p in before} == before  # nothing was rewritten
    assert {b for b, f in after.folders.items() if f != table.folders.get(b)} == set(hit)
    assert all(f in table.folders.values() for b, f in after.folders.items() if b not in hit)


@pytest.mark.parametrize("step", ["write", "_generation", "_switch"])
def test_readers_see_the_old_rows_until_the_switch(spark, accounts, monkeypatch, step):
    name, _ = accounts
    before, reader = rows(spark.table(name)), spark.table(name)

    def stop(*a, **k):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if step == "write":
            m.setattr(buckets, "_fs", stop)  # the data is written, nothing points at it
        else:
            m.setattr(buckets, step, stop)
        with pytest.raises(RuntimeError, match="stopped"):
            buckets.merge_into_buckets(spark, name, changed(spark, [str(k) for k in range(0, 1000, 9)], "D"), upsert_spec(["id"], "op"))
    assert rows(spark.table(name)) == before
    buckets.merge_into_buckets(spark, name, changed(spark, [str(k) for k in range(0, 1000, 9)], "D"), upsert_spec(["id"], "op"))
    assert spark.table(name).count() == 1000 - 112
    assert rows(reader) == before  # planned before the switch: all of the old rows


def test_ids_move_between_buckets(spark, accounts):
    name, base = accounts
    moves = spark.createDataFrame([("5", "a5"), ("6", "a6"), ("no", "x"), (None, "y")], "old_participant_id string, new_participant_id string")
    kept = files(base)
    buckets.rewrite_bucket_keys(spark, name, moves)
    found = spark.table(name).where("id in ('5', '6', 'a5', 'a6')")
    assert rows(found, "id", "plan") == [("a5", 5), ("a6", 6)] and spark.table(name).count() == 1000
    table = buckets.describe(spark, name)
    held = spark.table(table.generation).withColumn("want", buckets.bucket_of([F.col("id")], 16))
    assert not held.where("want <> _bucket").count()
    assert set(kept) <= set(files(base))


def test_emptied_buckets_and_expiry(spark, accounts):
    name, base = accounts
    for _ in range(2):
        buckets.merge_into_buckets(spark, name, changed(spark, [str(k) for k in range(1000)], "D"), MergeSpec(key_pairs(["id"]), (Clause("delete", "source.op = 'D'"),)))
    assert spark.table(name).count() == 0 and buckets.describe(spark, name).folders == {}
    gone = buckets.expire(spark, name)
    assert len(gone) == 16 and not files(base)
    buckets.merge_into_buckets(spark, name, changed(spark, ["1"]), upsert_spec(["id"]))
    assert rows(spark.table(name), "id", "plan") == [("1", 9)] and not buckets.expire(spark, name)


def test_null_keys_and_refused_changes(spark, accounts):
    name, _ = accounts
    buckets.merge_into_buckets(spark, name, changed(spark, [None, None, "1"]), upsert_spec(["id"]))
    assert spark.table(name).where("id is null").count() == 2 and spark.table(name).count() == 1002
    with pytest.raises(ValueError, match="bucket keys"):
        buckets.merge_into_buckets(spark, name, changed(spark, ["1"]), upsert_spec(["plan"]))
    with pytest.raises(ValueError, match="moves rows"):
        buckets.merge_into_buckets(spark, name, changed(spark, ["1"]), MergeSpec(key_pairs(["id"]), (Clause("update", None, {"id": "source.op"}),)))
    before = rows(spark.table(name))
    with pytest.raises(ValueError, match="do not name"):
        buckets.replace_buckets(spark, name, [(changed(spark, ["1"]), ["id"])], lambda t: t.withColumn("id", F.concat("id", F.lit("-"))))
    assert rows(spark.table(name)) == before
    with pytest.raises(ValueError, match="several source rows"):
        buckets.merge_into_buckets(spark, name, changed(spark, ["1", "1"]), upsert_spec(["id"]))


def test_a_feed_in_buckets_moves_ids_in_the_same_switch(spark):
    from ledgerflow.plans import raw_load

    database, base = f"bk_{uuid.uuid4().hex[:8]}", scratch_path(spark, "raw")
    staging = spark.createDataFrame([(f"p{k}", "1", str(k), "20240131") for k in range(200)] + [("p1", "1", "new", "20240201"), ("p900", "1", "900", "20240201")],
                                    "participant_id string, plan_number string, amount string, batch_date string")
    moves = spark.createDataFrame([("850", "p2", "q2"), ("900", "p3", "q3")], "admin_tran_code string, old_participant_id string, new_participant_id string")
    params = raw_load.FeedParams("omni_7.4", "FEED.NG", "balances", "incremental", ("plan_number", "participant_id"))
    switched = []
    for date, found in (("20240131", None), ("20240201", moves)):
        out = raw_load.staging_to_raw(spark, staging, params, date, base, database=database, bucketed=("participant_id", 16), id_changes=found)
        switched.append(buckets.describe(spark, out["valid"]).folders)
    assert rows(spark.table(out["valid"]).where("participant_id in ('p1', 'p2', 'p3', 'q2', 'p900')"), "participant_id", "amount") == [("p1", "new"), ("p3", "3"), ("p900", "900"), ("q2", "2")]
    assert spark.table(out["valid"]).count() == 201
    assert 1 <= sum(switched[0].get(b) != f for b, f in switched[1].items()) <= 4  # the buckets of p1, p900, p2 and q2
    with pytest.raises(ValueError, match="primary key to hash"):
        raw_load.staging_to_raw(spark, staging, params, "20240131", base, database=database, bucketed=("amount", 4))


def test_a_registered_table_is_switched_without_a_gap(spark, monkeypatch):
    from ledgerflow.sinks import writers

    name, base = f"bk_{uuid.uuid4().hex[:8]}.plain", scratch_path(spark, "plain")
    one, two = (spark.createDataFrame([(k, "x")], "id int, v string") for k in (1, 2))
    writers.register_table(spark, name, writers.write_version(one, base), one.schema)
    said, real = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), real(text, *a, **k))[1])
    writers.register_table(spark, name, writers.write_version(two, base), two.schema)
    assert rows(spark.table(name)) == [(2, "x")] and not any(t.startswith(("DROP", "CREATE TABLE")) for t in said)
    path = scratch_path(spark, "parted")
    for n in (2, 3):
        parted = spark.range(n).selectExpr("id", "cast(id as string) as part")
        writers.overwrite(parted, path, ["part"])
        writers.register_table(spark, f"{name}_parts", path, parted.schema, ["part"])
        assert spark.table(f"{name}_parts").count() == n
    assert not any(t.startswith("DROP") for t in said[1:] if "SYNC" in t)
    other = spark.createDataFrame([(1.5,)], "w double")
    writers.register_table(spark, name, writers.write_version(other, base), other.schema)
    assert rows(spark.table(name)) == [(1.5,)]


def test_latest_batches_prune_the_partitions_of_a_feed(spark):
    from ledgerflow.operators.joins import keep_latest_batches

    path = scratch_path(spark, "feed")
    spark.range(100).selectExpr("id", "cast(20240101 + id % 10 as string) as batch_date").write.partitionBy("batch_date").parquet(path)
    kept = keep_latest_batches(spark.read.schema("id long, batch_date string").parquet(path))
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in kept.select("batch_date").distinct().collect()} == {"20240109", "20240110"} and kept.count() == 20


def test_the_job_error_is_seen_when_the_audit_cannot_be_written(spark, tmp_path):
    from ledgerflow.sinks import writers

    (tmp_path / "audit").write_text("a file where the folder should be")

    def job():
        raise ValueError("the job's own")

    with pytest.raises(ValueError, match="the job's own") as failed:
        writers.run_with_audit(spark, f"{tmp_path}/audit/x", job, source_name="s", file_name="f", batch_date="b", table_name="t")
    assert any("audit row" in n for n in failed.value.__notes__)

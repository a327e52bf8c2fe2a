"""Row counts taken from the write, heavy join keys, and the choice of batches before wide rows."""

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from ledgerflow.operators import joins, quality
from ledgerflow.plans import raw_load, transform_load
from ledgerflow.plans.entities import txn as T
from ledgerflow.session import scratch_path
from ledgerflow.sinks import writers

STAGED = "plan_number string, participant_id string, amount string, source_cycle_date string, batch_date string"
PARAMS = raw_load.FeedParams("tpch", "FEED.NG", "counted", "full_load", ("plan_number", "participant_id"))


def staged(spark, n):
    got = [("000100", str(i % max(n - 3, 1)), str(i), "2024-01-31", "20240131") for i in range(n)]
    return spark.createDataFrame(got, STAGED).repartition(3)


def load(spark, n, params=PARAMS):
    base = scratch_path(spark, "counted")
    raw_load.staging_to_raw(spark, staged(spark, n), params, "20240131", base, audit_path=f"{base}/_audit")
    return base


@pytest.mark.parametrize("n, bad", [(20, 3), (0, 0)])
def test_the_audit_row_has_the_counts_of_the_load(spark, n, bad):
    base = load(spark, n)
    names = ("status", "record_count", "valid_count", "rejected_count")
    assert rows(writers.read_audit(spark, f"{base}/_audit"), *names) == [("SUCCESS", n, n - bad, bad)]


def test_feeds_without_flags_and_merged_feeds_are_counted(spark):
    for params in (raw_load.FeedParams("tpch", "FEED.NG", "counted"),
                   raw_load.FeedParams("tpch", "FEED.NG", "counted", "incremental", ("plan_number", "participant_id"))):
        base = load(spark, 20, params)
        bad = 3 if params.primary_keys else 0
        assert rows(writers.read_audit(spark, f"{base}/_audit"), "record_count", "rejected_count") == [(20, bad)]


def test_counting_adds_no_job(spark):
    def jobs(audited):
        group = f"counted-{audited}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            base = scratch_path(spark, "jobs")
            raw_load.staging_to_raw(spark, staged(spark, 20), PARAMS, "20240131", base, audit_path=f"{base}/_audit" if audited else None)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    assert jobs(True) - jobs(False) <= 1  # the write of the audit row itself


def test_a_transform_is_counted_and_a_failed_job_has_no_counts(spark):
    base = scratch_path(spark, "transform")
    build = lambda: spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    transform_load.raw_to_transform(spark, build, "things", ["k"], "full_load", f"{base}/t", f"{base}/e", "20240131", audit_path=f"{base}/_audit")

    def broken():
        raise RuntimeError("no feed")

    with pytest.raises(RuntimeError):
        transform_load.raw_to_transform(spark, broken, "things", ["k"], "full_load", f"{base}/t", f"{base}/e", "20240131", audit_path=f"{base}/_audit")
    assert rows(writers.read_audit(spark, f"{base}/_audit"), "status", "record_count") == [("FAILED", None), ("SUCCESS", 2)]


def test_audit_rows_of_before_counts_were_kept_are_read(spark):
    path = scratch_path(spark, "old-audit")
    spark.createDataFrame([("s", "f", "b", "t", "x", "y", "SUCCESS", "SYSTEM")], ", ".join(writers.AUDIT_SCHEMA.split(", ")[:8])).write.parquet(path)
    writers.run_with_audit(spark, path, lambda: 1, source_name="s", file_name="f", batch_date="b", table_name="t", counts=lambda: {"record_count": 7})
    assert rows(writers.read_audit(spark, path), "record_count", "valid_count") == [(None, None), (7, None)]


def half_null(spark, n=20000):
    left = spark.range(n).selectExpr("id", "if(id % 2 = 0, null, concat('k', id % 997)) AS k", "id % 7 AS v")
    right = spark.range(997).selectExpr("concat('k', id) AS rk", "id AS w").union(spark.sql("SELECT cast(null AS string), 5000L")).union(spark.sql("SELECT cast(null AS string), 5001L"))
    return left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_dealt_join_returns_the_rows_of_the_plain_join(spark, how):
    left, right = half_null(spark, 3000)
    right = right.where("rk is null or w % 3 > 0")
    plain = left.join(right, joins.sentinel_on(left, right, [("k", "rk")]), how)
    dealt = joins.dealt_join(left, right, [("k", "rk")], how)
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain)


def test_a_heavy_key_is_found_and_dealt_over_tasks(spark):
    left, right = half_null(spark)
    assert len(joins.heavy_keys(left, ["k"])) == 1
    assert joins.heavy_keys(left.where("k is not null"), ["k"]) == [] == joins.heavy_keys(left.limit(0), ["k"])
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

        def sizes(df):
            got = sorted(r["count"] for r in df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())
            return got[-1], got[len(got) // 2]

        most, median = sizes(joins.dealt_join(left, right, [("k", "rk")]))
        assert most <= 2 * median
        most, median = sizes(left.join(right, joins.sentinel_on(left, right, [("k", "rk")]), "left"))
        assert most > 4 * median  # what the plain join does
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_dealt_join_never_returns_unmatched_right_rows(spark):
    left, right = half_null(spark, 10)
    with pytest.raises(ValueError):
        joins.dealt_join(left, right, [("k", "rk")], "full")


def test_counts_wait_for_the_whole_frame(spark):
    df, counts = quality.observe_counts(spark.range(50).selectExpr("id", "id < 4 AS to_drop"))
    df.write.format("noop").mode("overwrite").save()
    assert counts() == {"record_count": 50, "valid_count": 46, "rejected_count": 4}


def test_batches_are_chosen_on_key_columns_alone(spark):
    """What is written before the choice has the key and the batch; no wide row is built for a losing batch."""
    from ledgerflow.bindings import registry

    sf = "/root/testdata/sf0.001"
    ng, jb, types = registry._txn_inputs(spark, sf)
    taken = types.select(*T.TYPE_COLUMNS).where("process_flag = 'Y'")
    chosen = T.latest_batch_of_keys([ng["feed"], jb["feed"]], taken, joins.prepared_types(taken), as_of="2024-02-01")
    assert chosen.columns == [f"_k{i}" for i in range(len(T.TXN_KEY))] + ["_top"]
    kept = T.keep_batch_of_keys(ng["feed"], chosen, as_of="2024-02-01")
    assert kept.columns == ng["feed"].columns and kept.count() <= ng["feed"].count()
    with pytest.raises(ValueError, match="category"):
        T.txn(ng, jb, types, key=("participant_id", "category"))


# ---- joins that make many rows of few ------------------------------------------------
@pytest.mark.parametrize("how", ["inner", "left"])
def test_product_join_deals_a_heavy_key_over_parts(spark, how):
    left = spark.createDataFrame([("a", i) for i in range(200)] + [("b", 1), ("none", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 7), ("b", 8), (None, 9)], "r string, w int")
    got = joins.product_join(left, right, [("k", "r")], how, part_pairs=500)
    assert rows(got) == rows(left.join(right, left["k"] == right["r"], how))
    parts = got.where("k = 'a'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 200 * 50 / 2


def test_rule_join_of_many_types_deals_their_products(spark, monkeypatch):
    codes = ", ".join(f"cast(NULL AS string) AS {c}" for c in joins.TYPE_CODE_COLUMNS)
    types = spark.range(40).selectExpr("if(id < 0, '100', '035') AS base_transaction_code", "'1' AS activity_type", "id AS tid", *codes.split(", "))
    txns = spark.range(300).selectExpr("if(id % 100 = 0, '100', '035') AS base_transaction_code", "cast(id AS string) AS activity_type", "id", *codes.split(", "))
    want = rows(joins.rule_join(txns, types, how="inner").select("id", "tt_tid"))
    monkeypatch.setattr(joins, "is_small", lambda *a, **k: False)
    monkeypatch.setattr(joins.product_join, "__defaults__", ("inner", 1000, 64))
    got = joins.rule_join(txns, types, how="inner")
    assert rows(got.select("id", "tt_tid")) == want
    assert got.select(F.spark_partition_id()).distinct().count() >= 4
    left = joins.rule_join(txns, types, how="left")
    assert left.count() == len(want) + 3 and left.where("tt_tid IS NULL").count() == 3


def test_a_batch_is_cleansed_once(spark):
    """Dates are parsed before the duplicates' join, which reads the rows twice."""
    df = staged(spark, 30).withColumn("trade_date", F.lit("01/31/2024"))
    got = raw_load.cleanse_batch(df, PARAMS, "20240131")
    assert "gettimestamp" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r[0] for r in got.select("trade_date").collect()} == {"2024-01-31"} and got.count() == 30

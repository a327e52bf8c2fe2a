from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators import quality, windows
from frame_rows import rows


def _dups(spark):
    data = [("k1", "20240101", "a"), ("k1", "20240101", "a"), ("k1", "20240101", "b"), ("k1", "20240102", "a"),
            (None, "20240101", "z"), (None, "20240101", "z"), ("k2", None, "q"), ("k2", "20240101", "q")]
    return spark.createDataFrame(data, "k string, batch_date string, v string")


def test_flag_duplicates_counts_and_first(spark):
    out = quality.flag_duplicates(_dups(spark), ["k"])
    got = rows(out, "k", "batch_date", "v", "to_drop")
    assert got.count(("k1", "20240101", "a", False)) == 1
    assert got.count(("k1", "20240101", "a", True)) == 1
    assert (None, "20240101", "z", False) in got and (None, "20240101", "z", True) in got
    assert ("k2", None, "q", False) in got  # NULL batch_date sorts first
    assert len(got) == 8 and sum(not r[3] for r in got) == 3


def test_flag_duplicates_hot_copy_group_chunks(spark):
    df = spark.range(0, 5000).select(F.lit("hot").alias("k"), F.lit("20240101").alias("batch_date"))
    out = quality.flag_duplicates(df, ["k"], chunk=64)
    agg = out.groupBy("to_drop").count().collect()
    assert {r.to_drop: r["count"] for r in agg} == {False: 1, True: 4999}


def test_split_and_drop_duplicates(spark):
    flagged = quality.flag_invalid_plan_ids(quality.flag_duplicates(
        spark.createDataFrame([("000005", "NG", "x"), ("000050", "NG", "y"), ("999998", "NG", "z"), ("999998", "JB", "w")],
                              "plan_number string, client_id string, batch_date string"), ["plan_number", "client_id"]))
    valid, rejected = quality.valid_rows(flagged), quality.rejected_rows(flagged)
    assert valid.count() + rejected.count() == 4
    assert rows(rejected, "plan_number", "drop_record_remarks") == [("000005", "invalid plan id"), ("999998", "invalid plan id")]
    assert "to_drop" not in valid.columns
    kept = quality.drop_duplicates_by_key(_dups(spark), ["k"], ["batch_date"])
    assert rows(kept) == [(None, "20240101", "z"), ("k1", "20240101", "a"), ("k2", None, "q")]


def test_sma_flag_last_writer_wins(spark):
    df = spark.createDataFrame([("1 2", "000003"), ("12", "000100")], "sma_fund_balance string, plan_number string")
    out = quality.flag_invalid_plan_ids(quality.flag_invalid_sma_balance(df))
    assert rows(out, "sma_fund_balance", "to_drop", "drop_record_remarks") == [("1 2", True, "invalid plan id"), ("12", False, None)]


def test_windows_match_rank_semantics(spark):
    data = [(k, d) for k in ("a", "b", "c") for d in ("1", "2", "2", "3", "3", None)] + [("n", None), ("n", None)]
    df = spark.createDataFrame(data, "k string, d string").withColumn("i", F.monotonically_increasing_id())
    w = Window.partitionBy("k").orderBy(F.col("d").desc())
    for n, fn in ((1, lambda: windows.latest_per_key(df, ["k"], "d")), (2, lambda: windows.top_ranks(df, ["k"], "d", 2))):
        expect = rows(df.withColumn("r", F.rank().over(w)).where(F.col("r") <= n).drop("r"))
        assert rows(fn()) == expect
    expect = rows(df.withColumn("r", F.dense_rank().over(w)).where(F.col("r") <= 2).drop("r"))
    assert rows(windows.top_ranks(df, ["k"], "d", 2, dense=True)) == expect


def test_number_within_key_with_copies_and_hot_key(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"),
        (F.col("id") % 5).alias("transaction_date"), F.lit("20240101").alias("batch_date"))
    out = windows.number_within_key(df, ["k"], ["transaction_date"], chunk=50)
    assert out.count() == 3000
    got = out.select("k", "transaction_date", F.split("newr_nqtxn_key", "_")[1].cast("int").alias("n")).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r.k, []).append((r.n, r.transaction_date))
    for k, pairs in by_key.items():
        pairs.sort()
        assert [p[0] for p in pairs] == list(range(1, len(pairs) + 1))
        assert [p[1] for p in pairs] == sorted(p[1] for p in pairs)


def test_top_ranks_many_values_hot_key(spark):
    hot = spark.range(0, 400).select(F.lit("hot").alias("k"), (F.col("id") % 37).cast("string").alias("d"))
    cold = spark.range(0, 60).select((F.col("id") % 6).cast("string").alias("k"),
                                     F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 4).cast("string")).alias("d"))
    df = hot.unionByName(cold).withColumn("i", F.monotonically_increasing_id())
    w = Window.partitionBy("k").orderBy(F.col("d").desc())
    for n in (1, 2, 3):
        for dense, fn in ((False, F.rank), (True, F.dense_rank)):
            expect = rows(df.withColumn("r", fn().over(w)).where(F.col("r") <= n).drop("r"))
            assert rows(windows.top_ranks(df, ["k"], "d", n, dense=dense)) == expect, (n, dense)

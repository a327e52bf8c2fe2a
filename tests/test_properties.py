"""Property tests (hypothesis): overpunch round trip, MERGE against a Python
model, valid + rejected = input."""

from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.functions import amounts, dates
from ledgerflow.operators import merge, quality
from frame_rows import rows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def encode(value: Decimal, precision: int, scale: int) -> str:
    digits = str(abs(int(value.scaleb(scale)))).rjust(precision, "0")
    if value < 0:
        return digits[:-1] + "pqrstuvwxy"[int(digits[-1])]
    return digits


@SETTINGS
@given(st.lists(st.decimals(min_value=Decimal("-99999999999.99"), max_value=Decimal("99999999999.99"), places=2),
                min_size=1, max_size=30))
def test_overpunch_round_trip(spark, values):
    df = spark.createDataFrame([(encode(v, 13, 2),) for v in values], "v string")
    out = df.select(amounts.decode_overpunch(F.col("v"), 13, 2).try_cast("decimal(13,2)").alias("d"))
    assert sorted(r.d for r in out.collect()) == sorted(values)


row = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", "c"]), st.sampled_from(["U", "D", None]))


def model_merge(target, source):
    """Python model: plain '=' keys, delete when op = 'D', else update, insert unmatched."""
    src = {}
    for k, v, op in source:
        if k is not None:
            src[k] = (k, v, op)
    out = []
    for k, v, op in target:
        s = src.get(k) if k is not None else None
        if s is None:
            out.append((k, v, op))
        elif s[2] != "D":
            out.append(s)
    tkeys = {k for k, _, _ in target if k is not None}
    out += [r for r in source if r[0] is None or r[0] not in tkeys]
    return out


@SETTINGS
@given(st.lists(row, max_size=12), st.lists(row, max_size=12, unique_by=lambda r: r[0]))
def test_merge_matches_model(spark, target, source):
    schema = "k int, v string, op string"
    t, s = spark.createDataFrame(target, schema), spark.createDataFrame(source, schema)
    got = merge.merge_frame(t, s, merge.upsert_spec(["k"], delete_code_col="op"))
    assert rows(got) == rows(spark.createDataFrame(model_merge(target, source), schema))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["000001", "000050", "999998", None]), st.sampled_from(["NG", "JB"]),
                          st.sampled_from(["20240101", "20240102"])), min_size=1, max_size=30))
def test_valid_plus_rejected_is_input(spark, data):
    df = spark.createDataFrame(data, "plan_number string, client_id string, batch_date string")
    flagged = quality.flag_invalid_plan_ids(quality.flag_duplicates(df, ["plan_number", "client_id"]))
    valid = quality.valid_rows(flagged)
    rejected = quality.rejected_rows(flagged).drop("to_drop", "drop_record_remarks")
    assert rows(valid.unionByName(rejected)) == rows(df)
    keys = [(r.plan_number, r.client_id) for r in valid.collect()]
    assert len(keys) == len(set(keys))


def test_batch_cutoff_without_cycle_column(spark):
    df = spark.createDataFrame([("x",)], "v string")
    assert dates.batch_date_by_cutoff(df, "20240115", "15:30").first().batch_date == "20240115"
    assert dates.batch_date_by_cutoff(df, "20240115", "07:00").first().batch_date == "20240114"


dup_row = st.tuples(st.sampled_from([None, "k1", "k2"]), st.sampled_from([None, 1, 2]),
                    st.sampled_from([None, "20240101", "20240102"]), st.sampled_from(["a", "b", None]))


@SETTINGS
@given(st.lists(dup_row, min_size=1, max_size=40))
def test_duplicate_flags_match_row_number(spark, data):
    from pyspark.sql import Window

    schema = "k string, n int, batch_date string, v string"
    df = spark.createDataFrame(data, schema)
    order = [F.col(c).asc_nulls_first() for c in ("batch_date", "v")]
    w = Window.partitionBy("k", "n").orderBy(*order)
    expect = df.withColumn("rn", F.row_number().over(w))
    flagged = quality.flag_duplicates(df, ["k", "n"], chunk=3)
    assert rows(flagged.select("k", "n", "batch_date", "v", "to_drop")) == rows(
        expect.select("k", "n", "batch_date", "v", (F.col("rn") > 1).alias("to_drop")))
    assert rows(quality.drop_duplicates_by_key(df, ["k", "n"], ["batch_date"])) == rows(
        expect.where("rn = 1").drop("rn"))

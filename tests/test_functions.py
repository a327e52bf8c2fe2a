import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.functions import amounts, cleansing, dates
from frame_rows import rows


def test_date_patterns_and_sentinels(spark):
    cases = {
        "01-02-24": "2024-01-02", "25/12/24": "2024-12-25", "13-01-2024": "2024-01-13", "20240102": "2024-01-02",
        "2024-01-02 10:11:12": "2024-01-02", "2024-02-30": None, "2024-1-2": None, "garbage-x": None,
        "2024-01-02T23:30:00.000-0500": "2024-01-02", "2024-01-02T23:30:00.000-05:00": "2024-01-02",
        "0000-00-00": None, "00/00/0000": None, "00000000": None, "1999.12.31": "1999-12-31", "short": None,
        "2024-01-02t23:30:00.000-0500": "2024-01-02",
    }
    df = spark.createDataFrame([(k,) for k in cases], "trade_date string")
    got = dict(rows(df.select("trade_date", dates.normalized_date(F.col("trade_date")).alias("d")), "trade_date", "d"))
    assert got == cases


def test_zoned_dates_do_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([("2024-01-02T23:30:00.000-0500",)], "d string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert df.select(dates.normalized_date(F.col("d"))).first()[0] == "2024-01-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_normalize_moves_date_columns_last_and_keeps_batch_date(spark):
    df = spark.createDataFrame([("20240131", "01/02/2024", "x", "20240101")], "batch_date string, start_dt string, name string, dob_date string")
    out = dates.normalize_date_columns(df)
    assert out.columns == ["batch_date", "name", "start_dt", "dob_date"]
    assert out.first().asDict() == {"batch_date": "20240131", "name": "x", "start_dt": "2024-01-02", "dob_date": "2024-01-01"}
    # the name rule also catches names like updated_by; an explicit list avoids it
    assert dates.date_columns(["updated_by", "trade_date"]) == ["updated_by", "trade_date"]
    assert dates.date_columns(["updated_by", "trade_date"], ["trade_date"]) == ["trade_date"]


def test_overpunch_fixture_values(spark):
    df = spark.createDataFrame([("000000001234q",), ("000000001234p",), ("0000000012345",), (None,), ("000000001234y",)], "v string")
    out = df.select(amounts.decode_overpunch(F.col("v"), 13, 2).try_cast("decimal(13,2)").alias("a"))
    assert sorted([r.a for r in out.collect()], key=lambda x: (x is None, x)) == [
        Decimal("-123.49"), Decimal("-123.41"), Decimal("-123.40"), Decimal("123.45"), None]


def test_overpunch_only_last_char(spark):
    df = spark.createDataFrame([("00000000p234q",)], "v string")
    assert df.select(amounts.decode_overpunch(F.col("v"), 13, 2)).first()[0] == "-00000000p23.41"


def test_junk_and_defaults(spark):
    df = spark.createDataFrame([("", "a\nb\r", 1, None), ("\n", "x", 2, "")], "a string, b string, n int, rev_code string")
    out = cleansing.fill_rev_code(cleansing.remove_junk_values(df))
    assert rows(out) == [(None, "a b ", 1, "0"), (" ", "x", 2, "0")]
    assert dict(out.dtypes)["n"] == "int"


def test_cycle_fill_and_remap_and_labels(spark):
    df = spark.createDataFrame([(None, None, "90", "F1", "2"), ("2024-01-05", "x", "91", "F2", "9"), (None, None, "12", "F3", "1")],
                               "source_cycle_date string, other string, fund_iv string, fund_code string, t string")
    out = cleansing.fill_cycle_dates(df, "20240131")
    out = cleansing.remap_loan_funds(out, "fund_code").withColumn("label", cleansing.beneficiary_label(F.col("t")))
    assert set(rows(out, "source_cycle_date", "other", "fund_code", "label")) == {
        ("2024-01-05", "x", "LN91", "Unknown"), ("2024-01-31", None, "LN90", "Organization"), ("2024-01-31", None, "F3", "Individual")}


def test_stub_null_keys_by_type(spark):
    df = spark.createDataFrame([(None, None, None)], "s string, d date, n int")
    out = cleansing.stub_null_keys(df, ["s", "d", "n"], date_default=F.lit("2000-01-01").cast("date")).first()
    assert (out.s, out.d, out.n) == ("-9999", dt.date(2000, 1, 1), -9999)


def test_batch_cutoff(spark):
    df = spark.createDataFrame([("2024-01-15",), ("2024-01-10",), ("2024-01-20",), ("2024-01",)], "source_cycle_date string")
    late = dict(rows(dates.batch_date_by_cutoff(df, "20240115", "16:00"), "source_cycle_date", "batch_date"))
    early = dict(rows(dates.batch_date_by_cutoff(df, "20240115", "09:00"), "source_cycle_date", "batch_date"))
    assert late == {"2024-01-15": "20240115", "2024-01-10": "20240110", "2024-01-20": "20240115"}
    assert early == {"2024-01-15": "20240114", "2024-01-10": "20240110", "2024-01-20": "20240114"}

"""Fixed-width files in UTF-16: splits, byte orders, blank and comment lines."""

from __future__ import annotations

import os
import tempfile

import pytest
from frame_rows import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.sources import files

LAYOUT = {"A": {"start": 1, "end": 3, "type": "string"}, "B": {"start": 4, "end": 6, "type": "string"}}


def put(folder, name, raw):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(raw)


@pytest.mark.parametrize("order,mark", [("utf-16-le", b"\xff\xfe"), ("utf-16-be", b"\xfe\xff"), ("utf-16-be", b"")])
def test_one_file_over_several_splits(spark, order, mark):
    folder = tempfile.mkdtemp(prefix="lf-utf16-")
    lines = [f"{k % 1000:03d}é{k % 97:02d}" for k in range(3000)] + ["", "-- a comment", "xyz   "]
    put(folder, "one.txt", mark + "\r\n".join(lines).encode(order))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        df = files.read_fixed_width(spark, folder, LAYOUT, "UTF-16", with_file_name=True)
        assert df.rdd.getNumPartitions() > 4
        got = sorted((r["a"], r["b"], r["file_segment"]) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert got == sorted([(f"{k % 1000:03d}", f"é{k % 97:02d}", "one.txt") for k in range(3000)] + [("", "", "one.txt"), ("xyz", "", "one.txt")])


def test_files_of_both_orders_and_utf8_agree(spark):
    folder, plain = tempfile.mkdtemp(prefix="lf-utf16-"), tempfile.mkdtemp(prefix="lf-utf8-")
    text = "abc123\n\nd\x00\x00456\n"
    put(folder, "le.txt", b"\xff\xfe" + text.encode("utf-16-le"))
    put(folder, "be.txt", b"\xfe\xff" + text.encode("utf-16-be"))
    put(plain, "u8.txt", text.encode() * 2)
    assert rows(files.read_fixed_width(spark, folder, LAYOUT, "UTF-16")) == rows(files.read_fixed_width(spark, plain, LAYOUT))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="abé中 1", min_size=1, max_size=6).map(str.strip), min_size=1, max_size=40))
def test_split_borders(spark, lines):
    folder = tempfile.mkdtemp(prefix="lf-utf16-")
    put(folder, "x.txt", b"\xff\xfe" + ("\n".join(lines) + "\n").encode("utf-16-le"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "17")
    try:
        got = files.read_fixed_width(spark, folder, LAYOUT, "UTF-16LE").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r["a"], r["b"]) for r in got) == sorted((line[:3].strip(), line[3:6].strip()) for line in lines)


def test_a_separator_across_characters_fails(spark):
    folder = tempfile.mkdtemp(prefix="lf-utf16-")
    put(folder, "x.txt", b"\xff\xfe" + "ਅĀa\n".encode("utf-16-le"))  # 05 0A 00 01: the bytes of a separator in the middle
    with pytest.raises(Exception, match="separator"):
        files.read_fixed_width(spark, folder, LAYOUT, "UTF-16").collect()

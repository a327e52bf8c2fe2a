import os
import tempfile

from pyspark.sql import functions as F

from ledgerflow.session import scratch_path
from ledgerflow.sinks import writers
from ledgerflow.sources import catalog, files
from frame_rows import rows

LAYOUT = {"ID": {"start": 1, "end": 4, "type": "int"}, "NAME": {"start": 5, "end": 10, "type": "string"},
          "FLAG": {"start": 11, "end": 11, "type": "string"}}


def _write(path, text, encoding):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as fh:
        fh.write(text)




def test_fixed_width_files(spark):
    d = tempfile.mkdtemp(prefix="lf-fixed-")
    body = "-- header line\n0007ab\x00\x00cd Y\n0012xyz   N\n0003s\n"
    _write(f"{d}/utf8/segment1.txt", body, "utf-8")
    _write(f"{d}/utf16/segment1.txt", body, "utf-16")
    expect = [("12", "xyz", "N"), ("3", "s", ""), ("7", "ab cd", "Y")]
    for enc, sub in (("UTF-8", "utf8"), ("UTF-16", "utf16")):
        out = files.read_fixed_width(spark, f"{d}/{sub}/segment*", LAYOUT, encoding=enc, with_file_name=True)
        assert rows(out, "id", "name", "flag") == expect
        assert rows(files.list_segments(out)) == [("segment1.txt",)]


def test_delimited_header_case_trim_and_quotes(spark):
    d = tempfile.mkdtemp(prefix="lf-psv-")
    _write(f"{d}/seg1.psv", 'Id|Name|Note\n 1 | Ann |"a|b"\n2||x\n', "utf-8")
    _write(f"{d}/seg2.psv", "", "utf-8")  # zero-byte segment
    out = files.read_delimited(spark, f"{d}/seg*", "Id string, Name string, Note string", "psv", True)
    assert out.columns == ["id", "name", "note"]
    assert rows(out) == [("1", "Ann", "a|b"), ("2", None, "x")]
    named = files.read_delimited(spark, f"{d}/seg*", "Id string, Name string, Note string", "psv", True, with_file_name=True)
    assert rows(files.list_segments(named)) == [("seg1.psv",)]


def test_predicate_scan_pushes_filters(spark):
    d = scratch_path(spark, "scan")
    spark.range(10).select(F.col("id"), (F.col("id") % 3).cast("string").alias("p")).write.partitionBy("p").parquet(d)
    df = catalog.read_path_table(spark, d, {"p": ["1", "2"], "id": 4})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan
    assert rows(df.select("id")) == [(4,)]
    import pytest
    with pytest.raises(TypeError):
        catalog.predicate({"p": object()})


def test_dynamic_overwrite_and_versions(spark):
    d = scratch_path(spark, "dyn")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    writers.overwrite(df, d, ["p"])
    writers.overwrite(spark.createDataFrame([(9, "a")], "v int, p string"), d, ["p"])
    assert rows(spark.read.parquet(d)) == [(2, "b"), (9, "a")]
    base = scratch_path(spark, "ver")
    writers.create_if_missing(spark, base, "k int, v string")
    assert writers.read_current(spark, base).count() == 0
    from ledgerflow.operators.merge import upsert_spec
    writers.merge_into(spark, base, spark.createDataFrame([(1, "x")], "k int, v string"), upsert_spec(["k"]))
    writers.merge_into(spark, base, spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string"), upsert_spec(["k"]))
    assert rows(writers.read_current(spark, base)) == [(1, "y"), (2, "z")]
    assert writers.current_path(spark, base).endswith("v000003")


def test_audit_records_failure(spark):
    import pytest
    path = scratch_path(spark, "audit")

    def boom():
        raise RuntimeError("bad feed")

    writers.run_with_audit(spark, path, lambda: 1, source_name="s", file_name="f", batch_date="20240101", table_name="t")
    with pytest.raises(RuntimeError):
        writers.run_with_audit(spark, path, boom, source_name="s", file_name="f", batch_date="20240101", table_name="t")
    assert rows(spark.read.parquet(path), "status") == [("FAILED",), ("SUCCESS",)]


def test_catalog_tables(spark):
    path = scratch_path(spark, "cat")
    df = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v int, batch_date string")
    writers.overwrite_table(df, "lf_test_db.t_batches", ["batch_date"], path=path)
    writers.overwrite_table(spark.createDataFrame([(5, "20240102")], "v int, batch_date string"),
                            "lf_test_db.t_batches", ["batch_date"], path=path)
    writers.append_table(spark.createDataFrame([(7, "20240103")], "v int, batch_date string"), "lf_test_db.t_batches",
                         ["batch_date"], path=path)
    assert catalog.table_exists(spark, "lf_test_db.t_batches")
    got = catalog.read_table(spark, "lf_test_db.t_batches", {"batch_date": ["20240101", "20240102"]})
    assert rows(got, "v", "batch_date") == [(1, "20240101"), (5, "20240102")]


def test_partition_merge_empties_a_partition(spark):
    from ledgerflow.operators.merge import upsert_spec

    path = scratch_path(spark, "pm")
    schema = "k int, p string, op string"
    writers.overwrite(spark.createDataFrame([(1, "a", "U"), (2, "a", "U"), (3, "b", "U")], schema), path, ["p"])
    source = spark.createDataFrame([(1, "a", "D"), (2, "a", "D"), (4, "c", "U")], schema)
    writers.merge_into_partitions(spark, path, source, upsert_spec(["k", "p"], delete_code_col="op"), ["p"])
    assert rows(spark.read.parquet(path).select("k", "p")) == [(3, "b"), (4, "c")]


def test_dispatch_stamps_and_create_if_missing(spark):
    import pytest

    with pytest.raises(ValueError):
        files.read_feed(spark, "/nowhere", "xml")
    with pytest.raises(ValueError):
        files.read_feed(spark, "/nowhere", "delimited")
    df = spark.createDataFrame([("x",)], "v string")
    stamped = files.stamp_file_segment(files.stamp_batch_date(df, "20240131"), "segment1")
    assert stamped.first().asDict() == {"v": "x", "batch_date": "20240131", "file_segment": "segment1"}
    base = scratch_path(spark, "k9")
    writers.create_if_missing(spark, base, "k int, run_date string", ["run_date"])
    writers.create_if_missing(spark, base, "k int, run_date string", ["run_date"])  # second call is a no-op
    assert writers.current_path(spark, base).endswith("v000001")
    assert writers.read_current(spark, base).count() == 0


def test_cluster_profile_sizing(spark):
    from ledgerflow import session

    assert session.shuffle_partitions_for(100 * 2**40) == 409600  # 100 TB at 256 MB per partition
    assert session.shuffle_partitions_for(10 * 2**20) == 200
    assert session.CLUSTER_CONF["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"

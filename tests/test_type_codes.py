"""Transactions whose code no type has are dropped at the scan; types are computed once; long stages are compiled."""

import pytest
from frame_rows import rows
from pyspark.sql import functions as F

from ledgerflow.operators import joins

TXN = "base_transaction_code string, activity_type string, " + ", ".join(f"{c} string" for c in joins.TYPE_CODE_COLUMNS)
CODES = ["035", "100", None, "777", "100"]


def _frames(spark):
    blank = [None] * len(joins.TYPE_CODE_COLUMNS)
    txn = spark.createDataFrame([(c, str(i % 2), *blank) for i, c in enumerate(CODES * 2)], TXN).withColumn("n", F.lit(1))
    types = spark.createDataFrame([(c, a, *blank) for c in ("035", "100", "900", None) for a in ("0", "1")], TXN)
    return txn, types


def test_rows_without_a_type_of_their_code_are_dropped_below_the_shuffle(spark):
    txn, types = _frames(spark)
    prepared = joins.prepared_types(types)
    for taken in (joins.typed_rows(txn.repartition(4).withColumn("m", F.col("n") + 1), prepared),
                  joins.rule_join(txn.repartition(4).withColumn("m", F.col("n") + 1), types, "inner", prepared=prepared)):
        plan = taken._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Repartition"):].partition("\n:- ")[0].partition("\n+- ")[0]
        assert "IN (035,100,900)" in below


@pytest.mark.parametrize("small", [True, False])
def test_the_filter_changes_no_row(spark, small, monkeypatch):
    txn, types = _frames(spark)
    full = joins.prepared_types(types, broadcast_types=small)
    none = joins.PreparedTypes(full.rows, full.keys, full.small)
    assert full.codes == ("035", "100", "900") and none.codes is None and full.small is small
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert rows(joins.rule_join(txn, types, how, prepared=full)) == rows(joins.rule_join(txn, types, how, prepared=none))
    assert joins.rule_join(txn, types.where("base_transaction_code IS NULL"), "inner").count() == 0


def test_many_codes_and_codes_that_are_no_text_are_not_listed(spark):
    _, types = _frames(spark)
    keys = joins.prepared_types(types).keys
    assert joins.few_codes(keys, most=3) == ("035", "100", "900")
    assert joins.few_codes(keys, most=2) is None
    assert joins.few_codes(keys.withColumn("_t_code", F.col("_t_code").cast("int"))) is None
    txn, _ = _frames(spark)
    numbers = txn.withColumn("base_transaction_code", F.col("base_transaction_code").cast("int"))
    prepared = joins.prepared_types(types)
    assert joins.of_codes(numbers, prepared) is numbers


def test_types_too_many_to_broadcast_are_computed_once(spark):
    _, types = _frames(spark)
    assert all("/rule-types-" in f for f in joins.prepared_types(types, broadcast_types=False).rows.inputFiles())
    assert joins.prepared_types(types, broadcast_types=False).rows.inputFiles()


def test_stages_too_long_for_the_compiler_run_by_operator_while_written(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), joins.compiled_methods(spark):
        assert int(spark.conf.get(name)) <= 8000
        raise ZeroDivisionError
    assert spark.conf.get(name) == before

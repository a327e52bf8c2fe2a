"""The plan entity's column maps against an oracle that does not share them."""

import duckdb
import pytest

from ledgerflow.bindings import plan_binding
from ledgerflow.bindings.feeds import TABLES, spark_sql
from ledgerflow.plans.entities import plan as P

SF = "/root/testdata/sf0.001"
# No branch fills these: they are in the target for feeds that are not read.
STUBS = {"source_processing_date", "sponsor_name_line_2"}


def expected():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(plan_binding.oracle_sql())
    return [d[0] for d in found.description], found.fetchall()


def columns_of(names, rows):
    return {n: sorted(str(r[i]) for r in rows) for i, n in enumerate(names)}


def test_every_mapped_column_has_values(spark):
    names, rows = expected()
    empty = {n for n, values in columns_of(names, rows).items() if set(values) == {"None"}}
    assert empty <= STUBS, sorted(empty - STUBS)


def test_swapped_map_entries_show(spark, monkeypatch):
    names, rows = expected()
    want = columns_of(names, rows)
    a, b = "ubs_financial_advisor", "ubs_plan_rep_id"
    swapped = {**P.DAILY_RENAMES, a: P.DAILY_RENAMES[b], b: P.DAILY_RENAMES[a]}
    monkeypatch.setattr(P, "DAILY_RENAMES", swapped)
    df = plan_binding.q_plan(spark, SF)
    got = columns_of(df.columns, [tuple(r) for r in df.collect()])
    assert {n for n in want if want[n] != got[n]} == {"financial_advisor", "rep_id"}


def test_a_feed_without_a_mapped_column_is_an_error(spark):
    f = {k: spark_sql(spark, SF, v) for k, v in plan_binding.FEEDS.items()}
    dims = {k: f[k] for k in plan_binding.DIMS}
    with pytest.raises(ValueError, match="roth_ind"):
        P.plan_daily(f["daily_ng"].drop("roth_ind"), dims, f["acct_ng"], "ng")
    with pytest.raises(ValueError, match="plan_sys_key"):
        P.plan_cef(f["cef"].drop("plan_sys_key"), f["contacts"])

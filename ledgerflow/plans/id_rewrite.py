"""Participant-id change / merge applied to a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.merge import rewrite_keys
from ledgerflow.sinks import writers
from ledgerflow.sources.catalog import read_table, table_exists

# Admin transaction codes for an id change and an id merge.
ID_CHANGE_CODES = ("850", "851")
# The only source whose incremental feeds get id rewrites, and
# the change table name per channel.
ID_REWRITE_SOURCE = "omni_7.4"
CHANGE_TABLE = "ssn_output_{channel}"


def channel_of(file_name: str) -> str | None:
    """NG / JB channel from a file name; None when neither (the job is skipped)."""
    if "NG" in file_name:
        return "NG"
    if "JB" in file_name:
        return "JB"
    return None


def id_changes_for(spark: SparkSession, source_name: str, file_name: str, file_load: str, database: str) -> DataFrame | None:
    """The id-change rows that apply to a feed, or None when the rewrite is
    skipped: other sources, non-incremental loads, transaction history
    feeds, file names without a channel, or a missing change table."""
    if source_name != ID_REWRITE_SOURCE or file_load != "incremental" or "SEQHIST" in file_name:
        return None
    channel = channel_of(file_name)
    if channel is None:
        return None
    table = f"{database}.{CHANGE_TABLE.format(channel=channel)}"
    if not table_exists(spark, table):
        return None
    return read_table(spark, table, {"admin_tran_code": list(ID_CHANGE_CODES)})


def id_changes(changes: DataFrame) -> DataFrame:
    """The change rows that rewrite ids (codes 850 and 851)."""
    return changes.where(F.col("admin_tran_code").isin(list(ID_CHANGE_CODES)))


def apply_id_changes(spark: SparkSession, table_base: str, changes: DataFrame, target_key: str = "participant_id") -> str:
    """Rewrite ``target_key`` (old -> new, one hop) in the current version of a
    path table and commit a new version.  Returns the new directory."""
    current = writers.read_current(spark, table_base)
    rewritten = rewrite_keys(current, id_changes(changes), target_key)
    return writers.write_version(rewritten, table_base)

"""A training corpus, cleaned in five stages; each calls one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All but the
last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import stages
from ledgerflow.llm.common import stage, table

#: In this order: name, function.
STAGES = [
    ("language_id", stages.language_id),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("secret_scan", stages.redact_secrets),
    ("byte_bpe", stages.encode),
]

#: The stages learn a model, follow links of any length and run a tokenizer, none of which SQL states.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

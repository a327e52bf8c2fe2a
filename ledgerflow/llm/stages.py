"""Stages of the corpus pipeline: each applies one operator's decisions.

All take ``(spark, docs, sf_dir)``.  Filtering stages return the documents
they keep with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import byte_bpe, decontaminate as decontamination, language_id as languages, near_dup as near_duplicates, secret_scan
from ledgerflow.llm.common import stage, table
from ledgerflow.llm.queries import RANKS


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language the calibrated model names."""
    named = languages.predict(docs, languages.fit(docs), out_col="_language")
    return named.where(~languages.rejected("_language")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the smallest id.

    Where ids repeat or are null, every row is a document of its own, so equal
    and similar rows keep one of them (an id before none) and unlike rows of
    one id all stay; rows without words are linked with nothing and stay."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if repeated.isEmpty():
        kept = near_duplicates.near_duplicates(docs).where("kept").select("doc_id")
        return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    row, component = "_row" + "_" * max(map(len, docs.columns)), "component_id"
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "near-dedup-rows")
    found = near_duplicates.near_duplicates(numbered, id_col=row).select(F.col("doc_id").alias(row), component)
    first = numbered.select(row, F.col("doc_id").alias("_id")).join(found, row).groupBy(component).agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", row)).alias("least"))
    return numbered.join(first.select(F.col("least")[row].alias(row)), row, "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no window of the benchmark."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    found = decontamination.contaminated_words(docs, table(spark, sf_dir, "benchmark"), keep=others)
    return found.where(F.size("hits") == 0).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep every document, with a mark in place of each secret."""
    found = secret_scan.scan(docs, secret_scan.words_by_rank(RANKS), out_col="_secrets")
    return secret_scan.redact(found, "_secrets").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    coded = byte_bpe.encode(docs, RANKS)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")

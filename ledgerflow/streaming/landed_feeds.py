"""Process newly landed delimited feed segments with Structured Streaming.

The batch jobs hand over between stages with marker files; here the
file source's own checkpoint remembers which segments were processed.
Each micro-batch is written to a staging table (once, even if it is run
again), and the ordinary staging -> raw job
(:func:`ledgerflow.plans.raw_load.staging_to_raw`) then runs over all that
is staged for its batch dates: segments of one date that land in several
micro-batches are loaded together.  With
``availableNow`` the stream processes everything present and stops, so it
fits a scheduled run as well as a long-running one.  The checkpoint lives
under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.plans.raw_load import FeedParams, rules_for_file, staging_to_raw
from ledgerflow.session import ensure_checkpoint_dir
from ledgerflow.sinks import writers
from ledgerflow.sinks.writers import read_partitioned
from ledgerflow.sources.files import DELIMITERS, normalize_headers_and_trim


def run_landed_feeds(spark: SparkSession, landing_dir: str, schema: StructType | str, params: FeedParams,
                     raw_base: str, file_format: str = "psv", header: bool = True, query_name: str | None = None,
                     available_now: bool = True):
    """Start (and with ``available_now`` wait for) a stream that loads each
    batch of landed segments into the raw layer, batch date from the path
    (``.../<yyyyMMdd>/...``)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    name = query_name or f"landed_{params.table_name}"
    stream = (spark.readStream.option("header", str(header).lower()).option("delimiter", DELIMITERS[file_format])
              .schema(schema).csv(landing_dir))
    stream = normalize_headers_and_trim(stream).withColumn(
        "batch_date", F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{8})/", 1))

    staging_path = f"{raw_base.rstrip('/')}/{params.source_name}/{params.table_name}_staging"
    parts = ["batch_date", "micro_batch"]

    def load(batch: DataFrame, batch_id: int) -> None:
        part = batch.withColumn("micro_batch", F.lit(str(batch_id)))
        writers.overwrite(part, staging_path, parts)  # dynamic: a repeated micro-batch replaces its own partitions
        staged = read_partitioned(spark, staging_path, parts).drop("micro_batch")
        dates = sorted(r.batch_date for r in batch.select("batch_date").distinct().collect())  # one row per batch date
        if params.file_load == "full_load" and not (params.rules or rules_for_file(params.file_name)).seqhist:
            # the current version is the latest date's; an older date that lands late does not replace it
            newest = staged.agg(F.max("batch_date")).first()[0]
            dates = [d for d in dates if d == newest]
        for date in dates:
            staging_to_raw(spark, staged, params, date, raw_base)

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{base}/streams/{name}").queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query

"""Keyed tables in hash buckets: a merge costs the buckets it touches (K5, K8).

A bucketed table is an external catalog table, partitioned by a hidden bucket
number (a hash of the merge key), behind a view of the table's own columns:

* a change reads only the buckets that its keys fall into (their numbers are
  literals in the scan's partition filter) and writes those buckets to a folder
  of its own; files of all other buckets are neither read nor rewritten;
* a new *generation* is a table whose partitions point at the old folders of
  untouched buckets and at the new folders of the others;
* the view is then replaced, one statement of the catalog: a reader sees all of
  the old rows or all of the new ones, and a job that stops anywhere before has
  changed nothing a reader can see.

The generation before stays for readers that run, older ones are dropped, and
``expire`` deletes folders that neither of the two points at.  One writer per
table is assumed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.operators.merge import MergeSpec, merge_frame, rewrite_keys
from ledgerflow.sinks.writers import _fs, drop_path, ensure_database

BUCKET = "_bucket"
#: Longest value of a table property that catalogs are sure to keep.
PROPERTY_CHARS = 3000
#: Partitions named in one statement.
PARTITIONS_AT_ONCE = 500


@dataclass(frozen=True)
class Bucketed:
    """What the view's properties say."""

    name: str
    base: str
    keys: tuple[str, ...]
    buckets: int
    generation: str
    before: str | None
    folders: dict[int, str]  # bucket -> folder of the write that holds it


def _quoted(name: str) -> str:
    return ".".join(f"`{x}`" for x in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def bucket_of(columns: Sequence[Column], buckets: int) -> Column:
    """Bucket number of a key; its columns must have the table's types."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def describe(spark: SparkSession, name: str) -> Bucketed:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}
    if "ledgerflow.generation" not in found:
        raise ValueError(f"{name} is not a bucketed table")
    parts = [found[f"ledgerflow.folders.{k}"] for k in range(int(found["ledgerflow.parts"]))]
    folders = {int(k): v for k, v in json.loads("".join(parts)).items()}
    return Bucketed(name, found["ledgerflow.base"], tuple(json.loads(found["ledgerflow.keys"])), int(found["ledgerflow.buckets"]), found["ledgerflow.generation"], found.get("ledgerflow.before") or None, folders)


def _generation(spark: SparkSession, table: Bucketed, schema: StructType) -> None:
    """A table over the folders; readers do not know it yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {_quoted(table.generation)} ({columns}, `{BUCKET}` INT) USING parquet PARTITIONED BY (`{BUCKET}`) LOCATION {_text(table.base)}")
    numbers = sorted(table.folders)
    for k in range(0, len(numbers), PARTITIONS_AT_ONCE):
        added = " ".join(f"PARTITION (`{BUCKET}` = {b}) LOCATION {_text(f'{table.base}/{table.folders[b]}/{BUCKET}={b}')}" for b in numbers[k:k + PARTITIONS_AT_ONCE])
        spark.sql(f"ALTER TABLE {_quoted(table.generation)} ADD {added}")


def _switch(spark: SparkSession, table: Bucketed, schema: StructType) -> None:
    """Point the view at the generation: the one step that readers see."""
    folders = json.dumps({str(k): v for k, v in sorted(table.folders.items())})
    parts = [folders[k:k + PROPERTY_CHARS] for k in range(0, len(folders), PROPERTY_CHARS)]
    values = {"generation": table.generation, "before": table.before or "", "base": table.base, "keys": json.dumps(table.keys), "buckets": str(table.buckets), "parts": str(len(parts)), **{f"folders.{k}": v for k, v in enumerate(parts)}}
    properties = ", ".join(f"{_text('ledgerflow.' + k)} = {_text(v)}" for k, v in values.items())
    columns = ", ".join(f"`{c}`" for c in schema.names)
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(table.name)} TBLPROPERTIES ({properties}) AS SELECT {columns} FROM {_quoted(table.generation)}")


def _next_name(name: str) -> str:
    return f"{name}__{uuid.uuid4().hex[:12]}"


def create(spark: SparkSession, name: str, base: str, schema: StructType | str, keys: Sequence[str], buckets: int) -> Bucketed:
    """An empty bucketed table ``database.table`` (K9: nothing happens if it exists)."""
    if spark.catalog.tableExists(name):
        return describe(spark, name)
    schema = spark.createDataFrame([], schema).schema
    if not keys or not set(keys) <= set(schema.names):
        raise ValueError("a bucketed table needs key columns of its own")
    ensure_database(spark, name)
    table = Bucketed(name, base.rstrip("/"), tuple(keys), buckets, _next_name(name), None, {})
    _generation(spark, table, schema)
    _switch(spark, table, schema)
    return table


def touched_buckets(table: Bucketed, schema: StructType, keys: Sequence[tuple[DataFrame, Sequence[str]]]) -> list[int]:
    """Buckets that the key columns of the given frames fall into: one row a
    bucket comes to the driver."""
    found: set[int] = set()
    for df, columns in keys:
        typed = [F.col(f"`{c}`").cast(schema[k].dataType) for c, k in zip(columns, table.keys, strict=True)]
        found |= {r[0] for r in df.select(bucket_of(typed, table.buckets).alias("b")).distinct().collect()}
    return sorted(found)


def target_rows(spark: SparkSession, table: Bucketed, buckets: Sequence[int]) -> DataFrame:
    """The table's rows in some buckets; no other folder is listed or read."""
    return spark.table(table.generation).where(F.col(BUCKET).isin(list(buckets))).drop(BUCKET)


def replace_buckets(spark: SparkSession, name: str, keys: Sequence[tuple[DataFrame, Sequence[str]]], change: Callable[[DataFrame], DataFrame]) -> Bucketed:
    """Replace the buckets that ``keys`` name by what ``change`` makes of their
    rows.  All rows it returns must fall into those buckets."""
    table = describe(spark, name)
    schema = spark.table(name).schema
    hit = touched_buckets(table, schema, keys)
    if not hit:
        return table
    rows = change(target_rows(spark, table, hit)).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    rows = rows.withColumn(BUCKET, bucket_of([F.col(f"`{k}`") for k in table.keys], table.buckets))
    folder = uuid.uuid4().hex[:12]
    path = f"{table.base}/{folder}"
    # a bucket's rows are brought together, and very large ones split again, by their sizes
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    fs, p, _ = _fs(spark, path)
    written = sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith(f"{BUCKET}="))
    if not set(written) <= set(hit):
        drop_path(spark, path)
        raise ValueError(f"{name}: the change moves rows to buckets that its keys do not name")
    folders = {b: f for b, f in table.folders.items() if b not in set(hit)} | {b: folder for b in written}
    after = Bucketed(name, table.base, table.keys, table.buckets, _next_name(name), table.generation, folders)
    _generation(spark, after, schema)
    _switch(spark, after, schema)
    if table.before:  # no view has pointed at it since the change before this one
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(table.before)}")
    return after


def merge_into_buckets(spark: SparkSession, name: str, source: DataFrame, spec: MergeSpec, check_unique: bool = True, moves: DataFrame | None = None,
                       old_col: str = "old_participant_id", new_col: str = "new_participant_id") -> Bucketed:
    """K5-K7: MERGE ``source`` into a bucketed table whose key columns are merge
    keys.  ``moves`` (old and new values of a single key column) are applied to
    the merged rows in the same switch (K8)."""
    table, source_of = describe(spark, name), dict(spec.on)
    if not set(table.keys) <= set(source_of):
        raise ValueError(f"{name}: bucket keys must be merge keys")
    if any(set(c.values or ()) & set(table.keys) for c in spec.clauses if c.kind == "update"):
        raise ValueError(f"{name}: an update of the key moves rows; use rewrite_bucket_keys")
    touched = [(source, [source_of[k] for k in table.keys])]
    if moves is None:
        return replace_buckets(spark, name, touched, lambda target: merge_frame(target, source, spec, check_unique))
    more, rewrite = _moved(table, moves, old_col, new_col)
    return replace_buckets(spark, name, touched + more, lambda target: rewrite(merge_frame(target, source, spec, check_unique)))


def _moved(table: Bucketed, moves: DataFrame, old_col: str, new_col: str) -> tuple[list[tuple[DataFrame, Sequence[str]]], Callable[[DataFrame], DataFrame]]:
    if len(table.keys) != 1:
        raise ValueError(f"{table.name}: ids are rewritten in tables with one bucket key")
    known = moves.where(F.col(old_col).isNotNull())
    return [(known, [old_col]), (known, [new_col])], lambda rows: rewrite_keys(rows, known, table.keys[0], old_col, new_col)


def rewrite_bucket_keys(spark: SparkSession, name: str, changes: DataFrame, old_col: str = "old_participant_id", new_col: str = "new_participant_id") -> Bucketed:
    """K8/T9 on a table with one bucket key: rows move from the buckets of old ids to those of new ones."""
    touched, rewrite = _moved(describe(spark, name), changes, old_col, new_col)
    return replace_buckets(spark, name, touched, rewrite)


def expire(spark: SparkSession, name: str) -> list[str]:
    """Delete bucket folders that neither the table nor the generation before
    it points at; their paths below the table's base."""
    table = describe(spark, name)
    live = {(f, b) for b, f in table.folders.items()}
    if table.before and spark.catalog.tableExists(table.before):
        for r in spark.table(table.before).select(BUCKET, F.regexp_extract(F.col("_metadata.file_path"), f"([0-9a-f]{{12}})/{BUCKET}=", 1).alias("folder")).distinct().collect():
            live.add((r["folder"], r[BUCKET]))
    fs, base, jvm = _fs(spark, table.base)
    gone = []
    for write in fs.listStatus(base):
        folder = write.getPath().getName()
        for part in fs.listStatus(write.getPath()):
            label = part.getPath().getName()
            if label.startswith(f"{BUCKET}=") and (folder, int(label.split("=")[1])) not in live:
                fs.delete(part.getPath(), True)
                gone.append(f"{folder}/{label}")
    return sorted(gone)

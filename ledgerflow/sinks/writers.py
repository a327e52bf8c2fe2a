"""Writers (K1-K4, K9, K10) and path tables that can be merged into.

A parquet directory cannot be overwritten by a job that reads it, so a
merged table is written as a new version directory (``v000001``, ...)
and readers take the newest version whose write committed (``_SUCCESS``).
A version is numbered above every folder present, so one that a failed
write left behind is passed over and never blocks the table.

Partitioned tables whose partition columns are part of the merge key
rewrite only the touched partitions: the merged rows of those partitions
are staged, then copied over with dynamic partition overwrite.  Between
the copy and the removal of emptied partitions the table is not
consistent; readers that need a snapshot use a versioned table.

Partition values are read with declared types.  Discovery would infer
them, and write a plan number ``000001`` back as ``1``; every table
written here carries its schema in a hidden file beside the data.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ledgerflow.operators.merge import MergeSpec, merge_frame
from ledgerflow.session import scratch_path

AUDIT_SCHEMA = (
    "source_name string, file_name string, batch_date string, table_name string, "
    "etl_start_datetime string, etl_end_datetime string, status string, created_by string, "
    "record_count long, valid_count long, rejected_count long"
)
# Audit status words and author.
STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED = "FAILED"
CREATED_BY = "SYSTEM"


# ---- plain writers ---------------------------------------------------------

def overwrite(df: DataFrame, path: str, partition_cols: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """K1 (no partitions) / K2 (partitions: only the partitions present in ``df`` are replaced)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    w.save(path)


def append(df: DataFrame, path: str, partition_cols: Sequence[str] | None = None, fmt: str = "parquet") -> None:
    """K3."""
    w = df.write.mode("append").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)


def export_parquet(df: DataFrame, path: str, partition_cols: Sequence[str] | None = None) -> None:
    """K4: parquet export, overwrite (dynamic when partitioned)."""
    overwrite(df, path, partition_cols, "parquet")


def overwrite_table(df: DataFrame, table: str, partition_cols: Sequence[str] | None = None, path: str | None = None) -> None:
    """K1/K2 on a catalog table (database created when missing, K9)."""
    ensure_database(df.sparkSession, table)
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if partition_cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    w.saveAsTable(table)


def append_table(df: DataFrame, table: str, partition_cols: Sequence[str] | None = None, path: str | None = None) -> None:
    """K3 on a catalog table (partition columns must match the table's)."""
    ensure_database(df.sparkSession, table)
    w = df.write.mode("append").format("parquet")
    if path:
        w = w.option("path", path)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.saveAsTable(table)


# Hidden file (Spark skips names that begin with an underscore) holding a table's schema.
SCHEMA_FILE = "_table_schema.json"


def save_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Keep a table's declared column types beside its data."""
    fs, p, jvm = _fs(spark, path)
    out = fs.create(jvm.org.apache.hadoop.fs.Path(p, SCHEMA_FILE), True)
    try:
        out.write(bytearray(schema.json().encode()))
    finally:
        out.close()


def saved_schema(spark: SparkSession, path: str) -> StructType | None:
    fs, p, jvm = _fs(spark, path)
    file = jvm.org.apache.hadoop.fs.Path(p, SCHEMA_FILE)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return StructType.fromJson(json.loads(text))


def read_declared(spark: SparkSession, path: str, types: Mapping[str, DataType] | None = None) -> DataFrame:
    """A path table read with its declared types: the saved schema's, else
    those in ``types``, else what the files say.  No partition value is inferred
    for a column whose type is declared."""
    saved = saved_schema(spark, path)
    if saved:
        return spark.read.schema(saved).parquet(path).select(*[F.col(f"`{c}`") for c in saved.names])
    if not types:
        return spark.read.parquet(path)
    found = spark.read.parquet(path).schema
    return spark.read.schema(StructType([StructField(f.name, types.get(f.name, f.dataType)) for f in found.fields])).parquet(path)


def read_partitioned(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> DataFrame:
    """A partitioned path table with its partition columns as strings."""
    from pyspark.sql.types import StringType

    return read_declared(spark, path, {c: StringType() for c in partition_cols})


def ensure_database(spark: SparkSession, table: str) -> None:
    """K9: ``CREATE DATABASE IF NOT EXISTS`` for a qualified name."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{table.split('.')[0]}`")


# ---- versioned path tables ---------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _version_folders(spark: SparkSession, base: str) -> dict[str, bool]:
    """Version folders under ``base``: name -> whether its write committed."""
    fs, p, jvm = _fs(spark, base)
    if not fs.exists(p):
        return {}
    out = {}
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v") and name[1:].isdigit():
            out[name] = fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
    return out


def _versions(spark: SparkSession, base: str) -> list[str]:
    return sorted(name for name, committed in _version_folders(spark, base).items() if committed)


def current_path(spark: SparkSession, base: str) -> str | None:
    """Directory of the newest committed version, or None for a missing table."""
    v = _versions(spark, base)
    return f"{base.rstrip('/')}/{v[-1]}" if v else None


def read_current(spark: SparkSession, base: str, schema: StructType | str | None = None) -> DataFrame:
    """The table's current version (empty frame of ``schema`` when missing)."""
    path = current_path(spark, base)
    if path is None:
        if schema is None:
            raise FileNotFoundError(f"no committed version under {base}")
        return spark.createDataFrame([], schema)
    return read_declared(spark, path)


def write_version(df: DataFrame, base: str, partition_cols: Sequence[str] | None = None, keep: int | None = None) -> str:
    """Write ``df`` as the next version; it becomes current when the job commits.
    ``keep``: committed versions that stay, this one included (None: all)."""
    spark = df.sparkSession
    folders = _version_folders(spark, base)
    path = f"{base.rstrip('/')}/v{max((int(v[1:]) for v in folders), default=0) + 1:06d}"
    save_schema(spark, path, df.schema)  # the write below appends beside it
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    if keep is not None:
        prune_versions(spark, base, keep)
    return path


def prune_versions(spark: SparkSession, base: str, keep: int) -> list[str]:
    """Delete all but the ``keep`` newest committed versions, and folders of
    failed writes older than those.  Returns the deleted names."""
    if keep < 1:
        raise ValueError("at least one version must be kept")
    folders = _version_folders(spark, base)
    stay = sorted(v for v, committed in folders.items() if committed)[-keep:]
    gone = sorted(v for v in folders if stay and v < stay[0])
    for name in gone:
        drop_path(spark, f"{base.rstrip('/')}/{name}")
    return gone


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this module wrote."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def create_if_missing(spark: SparkSession, base: str, schema: StructType | str, partition_cols: Sequence[str] | None = None) -> None:
    """K9: an empty first version with the given schema and partitions.  (No
    rows leave no file; the saved schema carries the columns and types.)"""
    if current_path(spark, base) is None:
        write_version(spark.createDataFrame([], schema), base, partition_cols)


def merge_into(spark: SparkSession, base: str, source: DataFrame, spec: MergeSpec,
               partition_cols: Sequence[str] | None = None, check_unique: bool = True,
               then: Callable[[DataFrame], DataFrame] | None = None, keep: int | None = None) -> str:
    """K5-K8/K11 on a versioned path table.  Creates the table from the
    source schema when missing.  ``then`` is applied to the merged rows before
    they are written, so a follow-up rewrite costs no second copy of the
    table.  Returns the new current directory."""
    if current_path(spark, base) is None:
        create_if_missing(spark, base, source.schema, partition_cols)
    merged = merge_frame(read_current(spark, base), source, spec, check_unique)
    return write_version(then(merged) if then else merged, base, partition_cols, keep)


def partition_filter(partition_cols: Sequence[str], values: Sequence[Sequence[object]]) -> Column:
    """Rows of the listed partitions, as literals that prune the scan."""
    def same(c: str, v: object) -> Column:
        return F.col(f"`{c}`").isNull() if v is None else F.col(f"`{c}`") == F.lit(v)

    if len(partition_cols) == 1:
        c, flat = partition_cols[0], [v[0] for v in values]
        known = F.col(f"`{c}`").isin([v for v in flat if v is not None])
        return known | F.col(f"`{c}`").isNull() if None in flat else known
    each = [reduce(lambda a, b: a & b, [same(c, v) for c, v in zip(partition_cols, row)]) for row in values]
    return reduce(lambda a, b: a | b, each) if each else F.lit(False)


def merge_into_partitions(spark: SparkSession, path: str, source: DataFrame, spec: MergeSpec,
                          partition_cols: Sequence[str], check_unique: bool = True) -> None:
    """K6 for a partitioned (non-versioned) table whose partition columns are
    merge keys: only partitions named by the source are read and replaced."""
    src_of = dict(spec.on)
    if not set(partition_cols) <= set(src_of):
        raise ValueError("partition columns must be merge keys to merge by partition")
    fs, p, _ = _fs(spark, path)
    names = list(partition_cols)
    # one row per touched partition: read once, and used as literals, so the scan lists no others
    touched = [tuple(r) for r in source.select(*[F.col(src_of[c]).alias(c) for c in names]).distinct().collect()]
    existed = fs.exists(p)
    if existed:
        declared = {c: source.schema[src_of[c]].dataType for c in names}
        target = read_declared(spark, path, declared).where(partition_filter(names, touched))
    else:
        target = spark.createDataFrame([], source.select(*[F.col(s).alias(t) for t, s in spec.on], *[
            c for c in source.columns if c not in src_of.values()]).schema)
    merged = merge_frame(target, source, spec, check_unique)
    staging = scratch_path(spark, "merge-stage")
    try:
        save_schema(spark, staging, target.schema)
        merged.write.mode("append").partitionBy(*names).parquet(staging)
        staged = read_declared(spark, staging).select(*target.columns)
        overwrite(staged, path, names)
        if not existed:
            save_schema(spark, path, target.schema)
        else:
            # dynamic overwrite leaves partitions that the merge emptied untouched: drop them
            after = {tuple(r) for r in staged.select(*names).distinct().collect()}
            for values in set(touched) - after:
                _drop_partition(spark, path, names, list(values))
    finally:
        drop_path(spark, staging)


def register_table(spark: SparkSession, table: str, path: str, schema: StructType, partition_cols: Sequence[str] | None = None) -> None:
    """K9: (re)point ``database.table`` of the catalog at ``path``.  The table is
    external: dropping or re-pointing it leaves the data.

    A table that exists with the same columns is never dropped: an unpartitioned
    one is re-pointed by one statement, so readers meet the old rows or the new
    ones, and a partitioned one in its old place has its partitions listed again."""
    ensure_database(spark, table)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    name = ".".join(f"`{x}`" for x in table.split("."))
    if spark.catalog.tableExists(table) and _same_shape(spark, table, schema, partition_cols):
        if not partition_cols:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        if _location(spark, name) == _fs(spark, path)[0].makeQualified(_fs(spark, path)[1]).toString():
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
            return
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parts} LOCATION '{path}'")
    if partition_cols:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def _same_shape(spark: SparkSession, table: str, schema: StructType, partition_cols: Sequence[str] | None) -> bool:
    found = spark.catalog.listColumns(table)
    parts = list(partition_cols or [])
    wanted = [(f.name, f.dataType.simpleString()) for f in schema.fields if f.name not in parts] + [(c, schema[c].dataType.simpleString()) for c in parts]
    return [(c.name, c.dataType) for c in found] == wanted and [c.name for c in found if c.isPartition] == parts


def _location(spark: SparkSession, name: str) -> str:
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    fs, p, _ = _fs(spark, detail["Location"])
    return fs.makeQualified(p).toString()


# The directory name Hive-style partitioning uses for a NULL value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _drop_partition(spark: SparkSession, path: str, cols: list[str], values: list) -> None:
    """Delete the directory of one partition (matched by listing, so value escaping needs no rules)."""
    from urllib.parse import unquote

    fs, base, jvm = _fs(spark, path)
    current = base
    for col, value in zip(cols, values):
        want = NULL_PARTITION if value is None else str(value)
        match = None
        for st in fs.listStatus(current):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(f"{col}=") and unquote(name[len(col) + 1:]) == want:
                match = st.getPath()
                break
        if match is None:
            return
        current = match
    fs.delete(current, True)


# ---- run audit (K10) ----------------------------------------------------------

def audit_row(spark: SparkSession, source_name: str, file_name: str, batch_date: str, table_name: str,
              start: str, end: str, status: str = STATUS_SUCCESS, created_by: str = CREATED_BY,
              counts: Mapping[str, int] | None = None) -> DataFrame:
    counted = [(counts or {}).get(c) for c in ("record_count", "valid_count", "rejected_count")]
    return spark.createDataFrame([(source_name, file_name, batch_date, table_name, start, end, status, created_by, *counted)], AUDIT_SCHEMA)


def read_audit(spark: SparkSession, audit_path: str) -> DataFrame:
    """All audit rows; those written before counts were kept have NULL counts."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)


def now_text() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def run_with_audit(spark: SparkSession, audit_path: str, job: Callable[[], object], *, source_name: str,
                   file_name: str, batch_date: str, table_name: str,
                   counts: Callable[[], Mapping[str, int]] | None = None) -> object:
    """Run ``job`` and append one audit row: SUCCESS, or FAILED before re-raising.
    ``counts`` gives the row counts of a job that succeeded; a failed one has none."""
    start = now_text()
    try:
        result = job()
    except Exception as failed:
        try:
            append(audit_row(spark, source_name, file_name, batch_date, table_name, start, now_text(), STATUS_FAILED), audit_path)
        except Exception as unwritten:  # the job's own error is what the caller must see
            failed.add_note(f"the audit row could not be written: {unwritten}")
        raise
    append(audit_row(spark, source_name, file_name, batch_date, table_name, start, now_text(), STATUS_SUCCESS, counts=counts() if counts else None), audit_path)
    return result

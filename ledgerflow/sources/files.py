"""File readers for staging feeds (delimited and fixed width).

Both readers are plain Spark scans: the delimited reader is the CSV
source with a declared schema (no inference pass), the fixed-width reader
is the text source followed by ONE projection that slices every field.
Both stay splittable, so a large segment is read by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Delimiter per declared file format.
DELIMITERS = {"psv": "|", "csv": ","}

# A fixed-width line starting with this marker is a comment.
COMMENT_PREFIX = "-- "
# A pair of NUL characters stands for one blank.
NUL_PAIR = "\x00\x00"


def feed_path(base: str, batch_date: str, source_name: str, file_name: str, segment_prefix: str = "") -> str:
    """Glob of a feed's segment files: ``base/batch_date/source/file/segment*``."""
    return f"{base.rstrip('/')}/{batch_date}/{source_name}/{file_name}/{segment_prefix}*"


def normalize_headers_and_trim(df: DataFrame) -> DataFrame:
    """Lower-case every column name and trim every value (spaces only)."""
    return df.select([F.trim(F.col(f"`{c}`")).alias(c.lower()) for c in df.columns])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    file_format: str = "psv",
    header: bool = True,
    with_file_name: bool = False,
) -> DataFrame:
    """Delimited scan with a fixed schema, then C1.

    ``with_file_name`` adds ``file_segment`` from the scan's file metadata
    (S7), so segment identity travels with the rows instead of being
    listed on the driver.
    """
    if file_format not in DELIMITERS:
        raise ValueError(f"unknown delimited format {file_format!r}; expected one of {sorted(DELIMITERS)}")
    reader = (
        spark.read.option("header", str(bool(header)).lower())
        .option("inferSchema", "false")
        .option("delimiter", DELIMITERS[file_format])
        .option("multiLine", "false")
        .schema(schema)
    )
    raw = reader.csv(path)
    cols = [F.trim(F.col(f"`{c}`")).alias(c.lower()) for c in raw.columns]
    if with_file_name:
        cols.append(F.col("_metadata.file_name").alias("file_segment"))
    return raw.select(*cols)


def _slice_fields(value: Column, layout: Mapping[str, Mapping]) -> list[Column]:
    cols = []
    for name, spec in layout.items():
        start, end = int(spec["start"]), int(spec["end"])
        piece = F.substring(value, start, end - start + 1)
        col_type = spec.get("type", "string")
        if col_type != "string":
            piece = piece.try_cast(col_type)
        cols.append(F.trim(piece.cast("string")).alias(name.lower()))
    return cols


def fixed_width_from_lines(lines: DataFrame, layout: Mapping[str, Mapping], value_col: str = "value") -> DataFrame:
    """S2 core: NUL pairs -> blank, drop comment lines, slice all fields in one select."""
    value = F.regexp_replace(F.col(value_col), NUL_PAIR, " ")
    extra = [c for c in lines.columns if c != value_col]
    return (
        lines.select(value.alias(value_col), *extra)
        .where(~F.col(value_col).startswith(COMMENT_PREFIX))
        .select(*_slice_fields(F.col(value_col), layout), *extra)
    )


# Byte-order marks.
BYTE_ORDER_MARKS = {b"\xff\xfe": "UTF-16LE", b"\xfe\xff": "UTF-16BE"}


def _utf16_files(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Files under ``path`` by byte order: two bytes of each are read.  A file
    without a mark is big-endian, as ``UTF-16`` means it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found: dict[str, list[str]] = {}
    for one in [path] if isinstance(path, str) else path:
        pattern = jvm.org.apache.hadoop.fs.Path(one)
        fs = pattern.getFileSystem(conf)
        listed = [st for top in fs.globStatus(pattern) or [] for st in (fs.listStatus(top.getPath()) if top.isDirectory() else [top])]
        for st in listed:
            if st.isDirectory() or st.getPath().getName().startswith(("_", ".")):
                continue
            stream = fs.open(st.getPath())
            try:
                head = bytes(max(stream.read(), 0) for _ in range(2)) if st.getLen() >= 2 else b""
            finally:
                stream.close()
            found.setdefault(BYTE_ORDER_MARKS.get(head, "UTF-16BE"), []).append(st.getPath().toString())
    return found


def _encoded_lines(spark: SparkSession, path: str | list[str], encoding: str, extra: list[Column]) -> DataFrame:
    """Lines of files in ``encoding`` with one record separator.  The text source cuts
    files at the separator's bytes, so they stay splittable, and leaves the
    bytes alone; they are decoded here.  In UTF-16 a separator's bytes can also
    lie across two characters; the piece they would cut has an odd length and
    fails the query."""
    raw = spark.read.option("encoding", encoding).option("lineSep", "\n").text(path)
    value = F.col("value").cast("binary")
    if encoding.startswith("UTF-16"):
        value = F.when(F.octet_length(value) % 2 == 0, value).otherwise(
            F.raise_error(F.lit("a line separator's bytes lie across two UTF-16 characters")).cast("binary"))
    text = F.regexp_replace(F.decode(value, encoding), "^\uFEFF|\r$", "")
    return raw.select(text.alias("value"), *extra)


def read_fixed_width(
    spark: SparkSession,
    path: str | list[str],
    layout: Mapping[str, Mapping],
    encoding: str = "UTF-8",
    with_file_name: bool = False,
) -> DataFrame:
    """Fixed-width scan.  ``layout`` is ``{column: {start, end, type}}``, 1-based inclusive.

    Every encoding goes through the splittable text source; ``UTF-16`` takes
    the byte order from each file's mark.  Blank lines are rows of empty fields.
    """
    name = encoding.upper().replace("_", "-")
    extra = [F.col("_metadata.file_name").alias("file_segment")] if with_file_name else []
    if name in ("UTF-8", "UTF8"):
        lines = spark.read.text(path).select("value", *extra)
    elif name in ("UTF-16", "UTF16"):
        parts = [_encoded_lines(spark, files, order, extra) for order, files in sorted(_utf16_files(spark, path).items())]
        if not parts:
            raise FileNotFoundError(f"no files under {path}")
        lines = reduce(lambda a, b: a.unionByName(b), parts)
    else:
        lines = _encoded_lines(spark, path, name, extra)
    return fixed_width_from_lines(lines, layout)


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    file_type: str,
    *,
    schema: StructType | str | None = None,
    layout: Mapping[str, Mapping] | None = None,
    file_format: str = "psv",
    header: bool = True,
    encoding: str = "UTF-8",
    with_file_name: bool = False,
) -> DataFrame:
    """S3: dispatch on the declared file type; unknown types raise."""
    if file_type == "delimited":
        if schema is None:
            raise ValueError("delimited feeds need a schema")
        return read_delimited(spark, path, schema, file_format, header, with_file_name)
    if file_type == "fixed_width":
        if layout is None:
            raise ValueError("fixed-width feeds need a layout")
        return read_fixed_width(spark, path, layout, encoding, with_file_name)
    raise ValueError(f"unknown file type {file_type!r}")


def stamp_batch_date(df: DataFrame, batch_date: str) -> DataFrame:
    """Constant ``batch_date`` (yyyyMMdd string)."""
    return df.withColumn("batch_date", F.lit(batch_date))


def stamp_file_segment(df: DataFrame, segment: str) -> DataFrame:
    """Constant ``file_segment``."""
    return df.withColumn("file_segment", F.lit(segment))


def list_segments(df_with_file_name: DataFrame) -> DataFrame:
    """Distinct segment names seen by a scan, as a DataFrame (no driver listing)."""
    return df_with_file_name.select("file_segment").distinct()

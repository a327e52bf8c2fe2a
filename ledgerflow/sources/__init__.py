"""Sources: staging file readers (S1-S3, S7) and table scans."""

from ledgerflow.sources.catalog import predicate, read_path_table, read_table, table_exists, union_channels
from ledgerflow.sources.files import (
    feed_path,
    fixed_width_from_lines,
    list_segments,
    normalize_headers_and_trim,
    read_delimited,
    read_feed,
    read_fixed_width,
    stamp_batch_date,
    stamp_file_segment,
)

__all__ = [
    "feed_path",
    "fixed_width_from_lines",
    "list_segments",
    "normalize_headers_and_trim",
    "predicate",
    "read_delimited",
    "read_feed",
    "read_fixed_width",
    "read_path_table",
    "read_table",
    "stamp_batch_date",
    "stamp_file_segment",
    "table_exists",
    "union_channels",
]

"""Sinks: overwrite / dynamic overwrite / append / export, versioned path
tables with MERGE, and the run audit."""

from ledgerflow.sinks.writers import (
    AUDIT_SCHEMA,
    append,
    append_table,
    audit_row,
    create_if_missing,
    current_path,
    ensure_database,
    export_parquet,
    merge_into,
    merge_into_partitions,
    overwrite,
    overwrite_table,
    read_audit,
    read_current,
    read_partitioned,
    run_with_audit,
    write_version,
)

__all__ = [name for name in dir() if not name.startswith("_")]

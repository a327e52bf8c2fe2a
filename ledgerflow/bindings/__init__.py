"""Bindings of the operators to the supplied test tables.

Each binding derives a feed from the TPC-H-style tables (shared SQL in the
dialect both Spark and DuckDB accept, so both engines see the same input),
runs the operator with ledgerflow on Spark, and has an independent DuckDB
oracle that states the operator's semantics in plain SQL.
"""

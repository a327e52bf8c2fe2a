"""Operators of a training-data pipeline, one module per operator.

Nothing outside this package imports it.  Each module keeps a general
interface over DataFrames; ``queries.py`` binds the operators to the supplied
tables.
"""

"""Operators of a training-data pipeline, one module each.

Nothing outside this folder imports it. ``queries`` holds the registered
``opN_`` queries and their DuckDB statements.
"""

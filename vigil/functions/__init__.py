"""Scalar and array functions: all built-in Spark expressions (no Python UDFs)."""

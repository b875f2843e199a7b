"""Contrail: a flight lakehouse on PySpark DataFrames and Structured Streaming."""

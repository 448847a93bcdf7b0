"""Streams, tables and logs as Spark DataFrames."""

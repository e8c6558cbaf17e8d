"""Temporal token-stream analytics on Spark DataFrames."""

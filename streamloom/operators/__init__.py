"""Operators over token streams and intervals: DataFrame in, DataFrame out."""

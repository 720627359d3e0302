"""Operators: DataFrames in, DataFrame out, no action inside."""

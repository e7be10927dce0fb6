"""Operators: pure functions from DataFrames and Columns to DataFrames and Columns."""

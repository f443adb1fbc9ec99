"""Operators that take and return DataFrames of records."""

"""Operators: DataFrames in, DataFrames out; nothing here starts a job."""

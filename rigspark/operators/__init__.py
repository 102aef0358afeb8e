"""Operators on capture tables: DataFrames in, DataFrames out."""

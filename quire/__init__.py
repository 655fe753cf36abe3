"""Bibliographic analytics as plain DataFrame functions: DataFrames in, DataFrames out."""

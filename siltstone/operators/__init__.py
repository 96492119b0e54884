"""Operators on DataFrames."""

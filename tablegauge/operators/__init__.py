"""Operators over DataFrames; each returns a DataFrame."""

"""Operators over timeline DataFrames; each is a function that returns a DataFrame."""

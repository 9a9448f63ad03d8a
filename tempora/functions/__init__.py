"""Scalar functions over columns."""

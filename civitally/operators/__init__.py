"""Operators: every one takes and returns a DataFrame."""

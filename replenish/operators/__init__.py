"""Operators of the replenishment engine; each takes DataFrames and returns a DataFrame."""

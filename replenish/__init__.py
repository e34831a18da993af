"""Replenishment-demand analytics on Spark DataFrames."""

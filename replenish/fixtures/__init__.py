"""Adapters that present the shared test tables in the input roles of the engine."""

"""Pipelines that compose operators and stored tables."""

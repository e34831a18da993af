"""Execution events as a stream: deduplication, line state, corrections and daily counts."""

"""Structured Streaming: insert-triggered marts and keep-latest tables."""

"""Structured Streaming queries built from the shared operators."""

"""Structured Streaming variants of the row-level operators."""

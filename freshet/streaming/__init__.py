"""Structured Streaming variants of the status refresh."""

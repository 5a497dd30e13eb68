"""Structured Streaming variants of the incremental load."""

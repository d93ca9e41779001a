"""Incremental versions of the batch work on Structured Streaming."""

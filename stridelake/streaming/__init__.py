"""Structured Streaming tables and the incremental pipeline."""

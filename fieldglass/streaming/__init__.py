"""Structured Streaming twins of the incremental operators."""

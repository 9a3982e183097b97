"""Structured Streaming: incremental refresh of window features."""

"""Incremental maintenance and sinks on Structured Streaming."""

"""Structured Streaming forms of the change-log operators."""

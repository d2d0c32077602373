"""Structured Streaming jobs for logs that keep arriving."""

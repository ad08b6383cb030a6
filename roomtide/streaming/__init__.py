"""Structured Streaming forms of operators over readings that keep arriving."""

"""Structured Streaming runners and running statistics."""

"""Structured Streaming forms of the landing and monitoring operators."""

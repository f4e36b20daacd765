"""Structured Streaming forms of three jobs."""

"""Structured Streaming forms of two batch jobs."""

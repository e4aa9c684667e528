"""Structured Streaming forms of the incremental and log jobs."""

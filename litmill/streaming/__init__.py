"""Structured Streaming forms of the page-by-page jobs."""

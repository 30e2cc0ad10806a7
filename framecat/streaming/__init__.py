"""Structured Streaming forms of arrival, deduplication, audit and ingest."""

"""Structured Streaming: typing, ingestion, removal of repeats, alerts."""

"""Structured Streaming forms of ingestion and roll-up."""

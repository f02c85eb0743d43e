"""Incremental ingestion of new delivery files (Structured Streaming)."""

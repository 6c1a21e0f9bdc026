"""Structured Streaming counterparts of ingestion and metric analytics."""

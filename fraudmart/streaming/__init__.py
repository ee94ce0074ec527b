"""Structured Streaming: exactly-once file ingestion and per-batch reports."""

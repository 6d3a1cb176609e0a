"""Structured Streaming ingest (availableNow file streams, idempotent micro-batches)."""

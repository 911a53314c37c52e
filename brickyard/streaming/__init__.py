"""Structured Streaming ingest: incremental bronze loads driven by a
checkpoint instead of a high-water-mark query."""

from brickyard.streaming.ingest import ingest_available, latest_by_key

__all__ = ["ingest_available", "latest_by_key"]

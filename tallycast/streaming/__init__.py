"""Incremental ingest of feed files with Structured Streaming."""

from tallycast.streaming.ingest import feed_stream, ingest, ingest_with_rejects, read_ingested, read_rejects

__all__ = ["feed_stream", "ingest", "ingest_with_rejects", "read_ingested", "read_rejects"]

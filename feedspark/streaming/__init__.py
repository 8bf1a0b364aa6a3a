"""Incremental ingest of landing files with Structured Streaming."""
from .ingest import start_feed_stream

__all__ = ["start_feed_stream"]

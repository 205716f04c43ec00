"""Structured Streaming: incremental (scheduled) extract ingest."""

from tagloom.streaming.ingest import start_extract_stream

__all__ = ["start_extract_stream"]

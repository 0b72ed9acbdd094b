"""Incremental (Structured Streaming) versions of the daily jobs."""

from coclick.streaming.daily import daily_cooccurrence_stream, daily_edges_stream, daily_stream

__all__ = ["daily_cooccurrence_stream", "daily_edges_stream", "daily_stream"]

"""Structured Streaming form of the incremental (hourly) layer refresh."""

from .incremental import IncrementalLake, start_incremental, trade_stream

__all__ = ["IncrementalLake", "start_incremental", "trade_stream"]

"""Structured Streaming form of the incremental load."""

from rides.streaming.file_arrival import start_trip_stream

__all__ = ["start_trip_stream"]

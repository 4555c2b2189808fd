"""Incremental bronze intake with Structured Streaming."""

from indtables.streaming.bronze_stream import conform_new_pulls

__all__ = ["conform_new_pulls"]

"""Incremental landing of the JSON logs (Structured Streaming)."""

from arenaflow.streaming.landing import land_log

__all__ = ["land_log"]

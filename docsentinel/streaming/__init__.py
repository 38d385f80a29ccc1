"""Structured Streaming ingestion of control events."""

from docsentinel.streaming.controlled_stream import ingest_controlled  # noqa: F401

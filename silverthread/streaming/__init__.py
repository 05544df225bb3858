"""Structured Streaming ingest of landed events."""

from .ids import IdIndex
from .ingest import events_stream, ingest_events, ingest_once

__all__ = ["IdIndex", "events_stream", "ingest_events", "ingest_once"]

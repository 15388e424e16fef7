"""Incremental, idempotent loading of landed order files."""

from cartwheel.streaming.ingest import IngestStats, ingest, start_ingest_stream

__all__ = ["ingest", "start_ingest_stream", "IngestStats"]

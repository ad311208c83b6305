"""Incremental ingest with Structured Streaming."""

from askmill.streaming.first_seen import first_seen_stream, survivors
from askmill.streaming.ingest import compact, dedup_stream, ingest_stream, read_sink, stream_csv, stream_parquet

__all__ = [
    "compact",
    "dedup_stream",
    "first_seen_stream",
    "ingest_stream",
    "read_sink",
    "stream_csv",
    "stream_parquet",
    "survivors",
]

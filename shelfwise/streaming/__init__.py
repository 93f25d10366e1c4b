"""Streaming jobs: publish events, land raw lines, load Bronze."""

from shelfwise.streaming.bronze_load import load_bronze
from shelfwise.streaming.file_load import LoadReport, load_files
from shelfwise.streaming.landing import (
    LANDED_FILES,
    land_raw,
    landed_lines,
    quarantined_lines,
    route_messages,
    undated_lines,
)
from shelfwise.streaming.publish import encode_events, publish, publish_stream
from shelfwise.streaming.running import StreamReport, reported, run_stream, stop_after_batch

__all__ = [
    "LANDED_FILES",
    "LoadReport",
    "StreamReport",
    "encode_events",
    "land_raw",
    "landed_lines",
    "load_bronze",
    "load_files",
    "publish",
    "publish_stream",
    "quarantined_lines",
    "reported",
    "route_messages",
    "run_stream",
    "stop_after_batch",
    "undated_lines",
]

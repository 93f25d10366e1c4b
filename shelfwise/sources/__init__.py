"""Readers for raw files, message topics and lakehouse tables."""

from shelfwise.sources.kafka import kafka_read_options, kafka_write_options, read_topic
from shelfwise.sources.raw_files import scan_raw, stream_raw
from shelfwise.sources.tables import full_refresh, read_bronze, read_rejects, read_table

__all__ = [
    "full_refresh",
    "kafka_read_options",
    "kafka_write_options",
    "read_bronze",
    "read_rejects",
    "read_table",
    "read_topic",
    "scan_raw",
    "stream_raw",
]

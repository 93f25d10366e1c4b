"""Encoding events as messages and publishing them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.events import encode_json
from shelfwise.schema import DEFAULT_TOPIC, EVENT_FIELDS
from shelfwise.sources.kafka import kafka_write_options


def encode_events(events: DataFrame, *columns: str) -> DataFrame:
    """One UTF-8 JSON message per row in a binary ``value`` column, without a key.

    NULL columns are left out, so a sale has no stock and a reading no quantity.
    """
    chosen = columns or tuple(name for name in EVENT_FIELDS if name in events.columns)
    return events.select(F.encode(encode_json(*chosen), "UTF-8").alias("value"))


def publish(messages: DataFrame, bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> None:
    messages.write.format("kafka").options(**kafka_write_options(bootstrap_servers, topic)).save()


def publish_stream(
    messages: DataFrame, bootstrap_servers: str, checkpoint: str, topic: str = DEFAULT_TOPIC
) -> StreamingQuery:
    return (
        messages.writeStream.format("kafka")
        .options(**kafka_write_options(bootstrap_servers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )

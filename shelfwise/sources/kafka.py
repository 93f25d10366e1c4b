"""Options for reading and writing a message topic.

The connector is Spark's own Kafka package; add it with ``--packages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.schema import DEFAULT_TOPIC, FLUSH_EVENTS, FLUSH_INTERVAL, MAX_BATCH_EVENTS, MAX_TASK_EVENTS


def _servers(bootstrap_servers: str) -> str:
    if not bootstrap_servers:
        raise ValueError("bootstrap_servers is required")
    return bootstrap_servers


def kafka_read_options(
    bootstrap_servers: str,
    topic: str = DEFAULT_TOPIC,
    group_id: str | None = None,
    flush_events: int = FLUSH_EVENTS,
    flush_interval: str = FLUSH_INTERVAL,
    max_events_per_batch: int | None = MAX_BATCH_EVENTS,
    max_events_per_task: int | None = MAX_TASK_EVENTS,
    poll_timeout_ms: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Read from the earliest offset; a batch starts at ``flush_events`` or ``flush_interval``.

    ``max_events_per_batch`` bounds a batch when catching up on a backlog, and
    ``max_events_per_task`` splits a hot topic partition over several tasks; None
    lifts either bound. Offsets
    that the topic no longer holds stop the stream unless ``fail_on_data_loss`` is
    off; offsets are kept in the checkpoint, not committed to the broker.
    """
    options = {
        "kafka.bootstrap.servers": _servers(bootstrap_servers),
        "subscribe": topic,
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(flush_events),
        "maxTriggerDelay": flush_interval,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    optional = {
        "kafka.group.id": group_id,
        "maxOffsetsPerTrigger": max_events_per_batch,
        "maxRecordsPerPartition": max_events_per_task,
        "kafkaConsumer.pollTimeoutMs": poll_timeout_ms,
    }
    options.update({key: str(value) for key, value in optional.items() if value is not None})
    return options


def kafka_write_options(bootstrap_servers: str, topic: str = DEFAULT_TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": _servers(bootstrap_servers), "topic": topic}


def read_topic(spark: SparkSession, bootstrap_servers: str, topic: str = DEFAULT_TOPIC, **kwargs) -> DataFrame:
    """The topic as a stream with a binary ``value`` column."""
    options = kafka_read_options(bootstrap_servers, topic, **kwargs)
    return spark.readStream.format("kafka").options(**options).load()

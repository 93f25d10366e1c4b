"""Landing a message stream as lines of JSON in a date tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfwise.functions.calendar import date_path, utc_today
from shelfwise.functions.events import (
    decode_text,
    field_text,
    from_iso,
    is_json_object,
    one_line,
    parse_event,
)

LANDED = "landed"
QUARANTINED = "quarantined"
UNDATED = "undated"

# Arguments for ``load_bronze`` and ``scan_raw`` that select the landed files and no others.
LANDED_FILES = {"name_glob": "*.txt", "path_regex": "/state=landed/"}

_LAYOUT = ("state", "y", "m", "d")
_ENCODED = "base64:"


def route_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Each message as one line of text with the place it is filed under.

    A message is filed under its own event date, or today's (UTC) when it has
    none. Its text is kept as it came, but for line breaks between the tokens of a
    JSON document, which become blanks. One that is not a JSON object, or whose
    date is there but cannot be read, is quarantined instead of stopping the stream:
    ``state=quarantined`` and ``state=undated`` hold them under the day they came.
    There a message that is one plain line stands as it came, and any other as
    ``base64:`` and the base64 of its bytes.
    """
    decoded = (
        messages.select(F.col(value).cast("binary").alias("bytes"))
        .withColumn("text", decode_text(F.col("bytes")))
        .withColumn("line", one_line(F.col("text")))
        .withColumn("event", parse_event(F.col("line")))
        .withColumn("date_text", F.trim(field_text("event_date")))
        .withColumn("own_date", from_iso(F.col("date_text"), "date"))
    )
    is_event = F.coalesce(is_json_object(F.col("line"), F.col("event")), F.lit(False))
    has_date = F.coalesce(F.col("date_text") != "", F.lit(False))
    state = (
        F.when(~is_event, F.lit(QUARANTINED))
        .when(has_date & F.col("own_date").isNull(), F.lit(UNDATED))
        .otherwise(F.lit(LANDED))
    )
    own_date = F.when(is_event, F.col("own_date"))
    plain = F.coalesce((F.col("line") == F.col("text")) & ~F.col("text").startswith(_ENCODED), F.lit(False))
    encoded = F.concat(F.lit(_ENCODED), F.base64("bytes"))
    return decoded.withColumn("state", state).select(
        "state",
        *date_path(F.coalesce(own_date, utc_today())),
        F.when((F.col("state") == LANDED) | plain, F.col("line")).otherwise(encoded).alias("value"),
    )


def landing_counts() -> list[Column]:
    """Aggregates for ``observe`` over routed messages: counted in the pass that writes them."""
    states = (LANDED, QUARANTINED, UNDATED)
    return [F.count(F.when(F.col("state") == state, 1)).alias(state) for state in states]


def land_raw(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
    value: str = "value",
    files_per_day: int | None = None,
) -> StreamingQuery:
    """Append messages below ``out/state=…/y=…/m=…/d=…/`` exactly once.

    One pass writes landed and quarantined lines. Without a ``trigger`` a batch
    runs as soon as the source offers one; a topic read with ``read_topic`` does
    so by count or time. Give other sources ``{"processingTime": "1 hour"}`` to
    gather as long, or ``{"availableNow": True}`` to drain what is there and stop.

    The counts of landed, quarantined and undated messages stand in each batch's progress
    under ``landing``. Lines of one day are brought together before
    the write, and Spark splits what is larger than its advisory partition size: a batch adds
    one file for a day with few lines, and for a busy one as many as its bytes ask for, each
    written by a task of its own. With ``files_per_day`` the lines of a day are dealt over so many
    tasks instead, whatever there is of them.
    """
    if not out or not checkpoint:
        raise ValueError("an output path and a checkpoint path are required")
    routed = route_messages(messages, value).observe("landing", *landing_counts())
    if files_per_day is None:
        dealt = routed.hint("rebalance", *_LAYOUT)
    else:
        dealt = routed.repartition(*_LAYOUT, F.pmod(F.xxhash64("value"), F.lit(files_per_day)))
    writer = (
        dealt.writeStream.format("text")
        .partitionBy(*_LAYOUT)
        .option("checkpointLocation", checkpoint)
        .option("path", out)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def _read_state(spark: SparkSession, out: str, state: str) -> DataFrame:
    schema = "value string, state string, y string, m string, d string"
    return spark.read.schema(schema).text(out).where(F.col("state") == state).drop("state")


def landed_lines(spark: SparkSession, out: str) -> DataFrame:
    return _read_state(spark, out, LANDED)


def quarantined_lines(spark: SparkSession, out: str) -> DataFrame:
    return _read_state(spark, out, QUARANTINED)


def undated_lines(spark: SparkSession, out: str) -> DataFrame:
    """Events whose date is there but cannot be read."""
    return _read_state(spark, out, UNDATED)

"""Lines of raw text to Bronze rows, for batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import utc_now
from shelfwise.functions.events import is_blank, parse_event

LOADED = "loaded"
REJECTED = "rejected"


def parse_lines(lines: DataFrame, line: str = "value", source_file: Column | None = None) -> DataFrame:
    """One row per non-blank line: the parsed event, or the rejected line itself.

    A ``source_file`` column says where the line came from; it is kept for
    rejected lines only, so loaded rows store nothing but the event.
    """
    origin = F.lit(None).cast("string") if source_file is None else source_file
    parsed = lines.where(~is_blank(F.col(line))).select(
        utc_now().alias("ingested_at"),
        parse_event(F.col(line)).alias("event"),
        F.col(line).alias("line"),
        origin.alias("source_file"),
    )
    bad = F.col("event").isNull()
    return parsed.select(
        "ingested_at",
        "event",
        F.when(bad, F.col("line")).alias("line"),
        F.when(bad, F.col("source_file")).alias("source_file"),
        F.when(bad, F.lit(REJECTED)).otherwise(F.lit(LOADED)).alias("status"),
    )


def bronze_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == LOADED).select("ingested_at", "event")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == REJECTED).select("ingested_at", "line", "source_file")


def load_counts() -> list[Column]:
    """Aggregates for ``observe`` over parsed lines: counted in the pass that writes them."""
    status = F.col("status")
    return [
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(status == LOADED, 1)).alias("loaded"),
        F.count(F.when(status == REJECTED, 1)).alias("rejected"),
    ]

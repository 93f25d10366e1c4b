"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of_week(date: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(date) - F.lit(1)


def calendar_parts(date: Column) -> list[Column]:
    return [
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        day_of_week(date).alias("day_of_week"),
    ]


def date_path(date: Column) -> list[Column]:
    """Year, month and day as zero-padded text columns ``y``, ``m`` and ``d``."""
    parts = (("y", F.year(date), 4), ("m", F.month(date), 2), ("d", F.dayofmonth(date), 2))
    return [F.lpad(part.cast("string"), width, "0").alias(name) for name, part, width in parts]


def utc_now() -> Column:
    """The time now in UTC, without a zone, whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())


def utc_today() -> Column:
    """Today's date in UTC, whatever the session time zone."""
    return F.to_date(utc_now())

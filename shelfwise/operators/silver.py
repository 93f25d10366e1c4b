"""Typed sales and inventory events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.events import any_field_failed, field, field_failed, field_or_null
from shelfwise.schema import INVENTORY, INVENTORY_FIELDS, SALE, SALE_FIELDS

_COMMON_FIELDS = ("event_time", "event_date", "store_id", "product_id")


def _failed(kind: Column) -> Column:
    """Whether a field that some table casts cannot be cast; all kinds share the date."""
    return (
        F.when(kind == SALE, any_field_failed(SALE_FIELDS))
        .when(kind == INVENTORY, any_field_failed(INVENTORY_FIELDS))
        .otherwise(field_failed("event_date"))
    )


def _getter(on_cast_error: str):
    check_cast_mode(on_cast_error)
    return field if on_cast_error == "raise" else field_or_null


def check_cast_mode(on_cast_error: str) -> None:
    if on_cast_error not in ("raise", "quarantine"):
        raise ValueError("on_cast_error is 'raise' or 'quarantine'")


def _keep(events: DataFrame, on_cast_error: str, failed: Column) -> DataFrame:
    return events if on_cast_error == "raise" else events.where(~failed)


def silver_events(bronze: DataFrame, on_cast_error: str = "raise") -> DataFrame:
    """Sales and inventory events typed in one pass over Bronze.

    Written partitioned by ``event_type``, this single table is both Silver
    tables: each is one partition and reads none of the other's files.
    """
    get = _getter(on_cast_error)
    kind = field("event_type")
    events = bronze.where(kind.isin(SALE, INVENTORY))
    return _keep(events, on_cast_error, _failed(kind)).select(
        *[get(name) for name in _COMMON_FIELDS],
        F.when(kind == SALE, get("qty")).alias("qty"),
        F.when(kind == INVENTORY, get("on_hand")).alias("on_hand"),
        kind,
    )


def _one_kind(bronze: DataFrame, kind: str, names: tuple[str, ...], on_cast_error: str) -> DataFrame:
    get = _getter(on_cast_error)
    events = bronze.where(field("event_type") == kind)
    return _keep(events, on_cast_error, any_field_failed(names)).select(*[get(name) for name in names])


def silver_sales(bronze: DataFrame, on_cast_error: str = "raise") -> DataFrame:
    return _one_kind(bronze, SALE, SALE_FIELDS, on_cast_error)


def silver_inventory(bronze: DataFrame, on_cast_error: str = "raise") -> DataFrame:
    return _one_kind(bronze, INVENTORY, INVENTORY_FIELDS, on_cast_error)


def cast_failures(bronze: DataFrame) -> DataFrame:
    """The Bronze rows that the quarantine mode leaves out of Silver or the dimensions."""
    return bronze.where(_failed(field("event_type")))

"""Date, store and product dimensions over every kind of event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.calendar import calendar_parts
from shelfwise.functions.events import field, field_failed, field_or_null, has_field
from shelfwise.operators.silver import check_cast_mode

# Value of grouping_id(date, store_id, product_id) for each one-column grouping set.
_DATE_SET, _STORE_SET, _PRODUCT_SET = 0b011, 0b101, 0b110


def _distinct(values: DataFrame, column: str, drop_null_keys: bool) -> DataFrame:
    kept = values.where(F.col(column).isNotNull()) if drop_null_keys else values
    return kept.distinct()


def _with_calendar(dates: DataFrame) -> DataFrame:
    return dates.select("date", *calendar_parts(F.col("date")))


def _date(on_cast_error: str) -> tuple[Column, Column]:
    """The event date, and whether the event carries one that counts."""
    check_cast_mode(on_cast_error)
    present = has_field("event_date")
    if on_cast_error == "raise":
        return field("event_date").alias("date"), present
    return field_or_null("event_date").alias("date"), present & ~field_failed("event_date")


def dim_date(
    bronze: DataFrame, drop_null_keys: bool = False, on_cast_error: str = "raise"
) -> DataFrame:
    date, present = _date(on_cast_error)
    dates = bronze.where(present).select(date)
    return _with_calendar(_distinct(dates, "date", drop_null_keys))


def dim_store(bronze: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    stores = bronze.where(has_field("store_id")).select(field("store_id"))
    return _distinct(stores, "store_id", drop_null_keys)


def dim_product(bronze: DataFrame, drop_null_keys: bool = False) -> DataFrame:
    products = bronze.where(has_field("product_id")).select(field("product_id"))
    return _distinct(products, "product_id", drop_null_keys)


def dimension_members(bronze: DataFrame, on_cast_error: str = "raise") -> DataFrame:
    """The members of all three dimensions from one scan and one shuffle.

    Grouping sets count each column on its own; ``present`` tells a member that
    is a JSON null from events which lack the field.
    """
    date, date_present = _date(on_cast_error)
    values = bronze.select(
        date,
        field("store_id"),
        field("product_id"),
        date_present.alias("has_date"),
        has_field("store_id").alias("has_store"),
        has_field("product_id").alias("has_product"),
    )
    keys = ("date", "store_id", "product_id")
    grouped = values.groupingSets([["date"], ["store_id"], ["product_id"]], *keys).agg(
        F.grouping_id(*keys).cast("int").alias("member_of"),
        F.max("has_date").alias("has_date"),
        F.max("has_store").alias("has_store"),
        F.max("has_product").alias("has_product"),
    )
    present = (
        F.when(F.col("member_of") == _DATE_SET, F.col("has_date"))
        .when(F.col("member_of") == _STORE_SET, F.col("has_store"))
        .otherwise(F.col("has_product"))
    )
    return grouped.where(present).select("member_of", *keys)


def members_to_dim_date(members: DataFrame) -> DataFrame:
    return _with_calendar(members.where(F.col("member_of") == _DATE_SET))


def members_to_dim_store(members: DataFrame) -> DataFrame:
    return members.where(F.col("member_of") == _STORE_SET).select("store_id")


def members_to_dim_product(members: DataFrame) -> DataFrame:
    return members.where(F.col("member_of") == _PRODUCT_SET).select("product_id")

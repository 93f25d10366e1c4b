"""Daily facts per date, store and product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.ranking import latest_per_key
from shelfwise.schema import DAILY_KEYS, NUMBER


def fact_sales_daily(sales: DataFrame) -> DataFrame:
    """Units sold and number of sales; partial sums leave one row per key and task to shuffle."""
    return (
        sales.withColumnRenamed("event_date", "date")
        .groupBy(*DAILY_KEYS)
        .agg(
            F.sum(F.col("qty").cast(NUMBER)).alias("total_qty_sold"),
            F.count(F.lit(1)).alias("sales_event_count"),
        )
    )


def fact_inventory_daily(inventory: DataFrame) -> DataFrame:
    """The latest reading of each day, store and product.

    A reading without a time counts as the newest; of equal times the lowest stock wins,
    and a reading without a stock comes last. Each task keeps one row per key before the
    shuffle, however many readings a key has.
    """
    readings = inventory.select(
        F.col("event_date").alias("date"),
        "store_id",
        "product_id",
        F.col("on_hand").cast(NUMBER).alias("on_hand_latest"),
        F.col("event_time").alias("last_inventory_time"),
    )
    newest = [F.col("last_inventory_time").desc_nulls_first(), F.col("on_hand_latest").asc_nulls_last()]
    return latest_per_key(readings, DAILY_KEYS, newest)

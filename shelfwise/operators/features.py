"""The labelled daily feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.schema import DAILY_KEYS, LABEL_COLUMN, LOW_STOCK_THRESHOLD


def features_daily(
    sales_fact: DataFrame, inventory_fact: DataFrame, threshold: int = LOW_STOCK_THRESHOLD
) -> DataFrame:
    """Every row of the sales fact with that day's latest stock and the low-stock label.

    Both facts are unique on the three keys, and computed facts are already
    partitioned on them, so the join adds no shuffle of its own. No stock reading
    gives label 0; a NULL key matches nothing.
    """
    stock = inventory_fact.select(*DAILY_KEYS, "on_hand_latest")
    low = F.col("on_hand_latest") <= F.lit(threshold)
    return sales_fact.join(stock, list(DAILY_KEYS), "left").select(
        *DAILY_KEYS,
        "total_qty_sold",
        "sales_event_count",
        "on_hand_latest",
        F.when(low, F.lit(1)).otherwise(F.lit(0)).alias(LABEL_COLUMN),
    )

"""Latest row per key, top-k and the run report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.schema import FEATURE_COLUMNS, LABEL_COLUMN, PROBABILITY_COLUMN, REPORT_SIZE


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark cuts each task's rows to one per key before the shuffle, so a hot key
    sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def top_k(df: DataFrame, order: Sequence[Column], k: int = REPORT_SIZE) -> DataFrame:
    """The first k rows in the given order: each task keeps k, the driver merges them."""
    return df.orderBy(*order).limit(k)


def recent_sales(sales_fact: DataFrame, k: int = REPORT_SIZE) -> DataFrame:
    """The newest rows of the sales fact; a row without a date comes first."""
    order = [F.col("date").desc_nulls_first(), F.col("store_id").asc(), F.col("product_id").asc()]
    return top_k(sales_fact, order, k)


def riskiest(predicted: DataFrame, k: int = REPORT_SIZE, nulls_first: bool = True) -> DataFrame:
    """The rows of highest predicted risk; equal risks are ordered by the other columns."""
    probability = F.col(PROBABILITY_COLUMN)
    first = probability.desc_nulls_first() if nulls_first else probability.desc_nulls_last()
    rest = [F.col(name).asc() for name in predicted.columns if name != PROBABILITY_COLUMN]
    return top_k(predicted, [first, *rest], k)


def run_report(predicted: DataFrame, k: int = REPORT_SIZE) -> tuple[int, DataFrame]:
    """Number of rows used, and the rows of highest risk with unknown risks last.

    One pass over them: equal rows are merged and counted first, which leaves few, and
    both the number and the ``k`` rows that are shown come from these.
    """
    columns = [*FEATURE_COLUMNS, LABEL_COLUMN, PROBABILITY_COLUMN]
    merged = predicted.groupBy(*columns).agg(F.count(F.lit(1)).alias("_times")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = merged.agg(F.sum("_times")).first()[0] or 0
        # Of equal rows no more than k can be shown.
        repeated = merged.withColumn("_time", F.explode(F.sequence(F.lit(1), F.least("_times", F.lit(k)).cast("int"))))
        shown = repeated.select(*columns)
        top = riskiest(shown, k, nulls_first=False).collect()
    finally:
        merged.unpersist()
    return rows, predicted.sparkSession.createDataFrame(top, shown.schema)

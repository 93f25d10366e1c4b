"""Runs as a whole: one row names the current run, and a reader's tables all come from it."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.calendar import utc_now
from shelfwise.plans.refresh import Lakehouse
from shelfwise.sources.tables import exists

PREDICTED = ("stockout_predictions", "stockout_predictions_keyed")
TABLES = (
    "sales_events",
    "inventory_events",
    "dim_date",
    "dim_store",
    "dim_product",
    "fact_sales_daily",
    "fact_inventory_daily",
    "features_daily",
    *PREDICTED,
)
_RUNS = "run bigint, root string, published_at timestamp_ntz"


def publish_run(tables: Lakehouse, runs: str) -> int:
    """Make a finished run the current one, and return its number.

    Adds one row to the table ``runs``: a file that is there as a whole or not at all. All tables of
    the run switch with it, since readers take the run from that row. One publisher at a time.
    """
    spark = tables.spark
    number = 0 if not exists(spark, runs) else spark.read.schema(_RUNS).parquet(runs).agg(F.coalesce(F.max("run") + 1, F.lit(0))).first()[0]
    row = spark.range(1).select(F.lit(number).cast("bigint").alias("run"), F.lit(tables.root).alias("root"), utc_now().alias("published_at"))
    row.coalesce(1).write.mode("append").parquet(runs)
    return number


def current_run(spark: SparkSession, runs: str) -> Lakehouse:
    """The tables of the run published last, whatever is published while they are read."""
    if not exists(spark, runs):
        raise FileNotFoundError(f"no run is published in {runs}")
    newest = spark.read.schema(_RUNS).parquet(runs).orderBy(F.desc("run")).limit(1).first()
    return Lakehouse(spark, newest["root"])


def open_run(spark: SparkSession, runs: str, prefix: str = "") -> Lakehouse:
    """Views of this session over the tables of the current run, all of that one run until the next call.

    They are called ``sales_events``, ``dim_date``, ``features_daily`` and so on, after the prefix;
    ``stockout_predictions`` if the run has them. A query that joins them never mixes two runs, as
    one over catalog views could that are replaced one by one.
    """
    tables = current_run(spark, runs)
    for name in TABLES:
        if name not in PREDICTED or exists(spark, tables.path(f"gold.{name}")):
            getattr(tables, name).createOrReplaceTempView(prefix + name)
    return tables

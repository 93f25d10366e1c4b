"""Catalog views over the tables of one refresh."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from shelfwise import schema as S
from shelfwise.plans.refresh import Lakehouse

_GOLD = {
    "gold.dim_date": S.DIM_DATE_SCHEMA,
    "gold.dim_store": S.DIM_STORE_SCHEMA,
    "gold.dim_product": S.DIM_PRODUCT_SCHEMA,
    "gold.fact_sales_daily": S.FACT_SALES_SCHEMA,
    "gold.fact_inventory_daily": S.FACT_INVENTORY_SCHEMA,
    "gold.features_daily": S.FEATURES_SCHEMA,
}
_SILVER = {
    "silver.sales_events": (S.SALE, S.SALES_EVENTS_SCHEMA),
    "silver.inventory_events": (S.INVENTORY, S.INVENTORY_EVENTS_SCHEMA),
}


def publish_views(tables: Lakehouse, bronze: str | None = None, with_predictions: bool = False) -> None:
    """Point the catalog at a refresh: ``silver.sales_events``, ``gold.dim_date`` and so on.

    The views are replaced one after the other. Each switches at once, from a whole old
    table to a whole new one; a query that joins two of them while they switch can read
    one of either run.
    """
    spark = tables.spark
    for namespace in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    if bronze is not None:
        _view(spark, "bronze.raw_events", bronze, S.BRONZE_SCHEMA, "status = 'loaded'")
    for name, (kind, columns) in _SILVER.items():
        _view(spark, name, tables.path("silver.events"), columns, f"event_type = '{kind}'")
    for name, columns in _GOLD.items():
        _view(spark, name, tables.path(name), columns, "true")
    if with_predictions:
        publish_predictions(tables)


def publish_predictions(tables: Lakehouse, keyed: bool = False) -> None:
    """Point ``gold.stockout_predictions`` at a run's, and the table with the keys if it was written."""
    spark = tables.spark
    spark.sql("CREATE SCHEMA IF NOT EXISTS gold")
    name = "gold.stockout_predictions"
    _view(spark, name, tables.path(name), S.PREDICTIONS_SCHEMA, "true")
    if keyed:
        _view(spark, f"{name}_keyed", tables.path(f"{name}_keyed"), S.KEYED_PREDICTIONS_SCHEMA, "true")


def _view(spark: SparkSession, name: str, path: str, columns: T.StructType, condition: str) -> None:
    # A partition column's type is guessed from the folders' names, so it is stated here.
    chosen = ", ".join(
        f"`{f.name}`" if isinstance(f.dataType, T.VariantType) else f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in columns.fields
    )
    try:
        spark.read.parquet(path)
        body = f"SELECT {chosen} FROM parquet.`{path}` WHERE {condition}"
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        # A partitioned table without rows has no file to take a schema from.
        empty = ", ".join(
            f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in columns.fields
        )
        body = f"SELECT {empty} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body}")

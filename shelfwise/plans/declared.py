"""Catalog tables with declared columns and types, in place of views over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfwise import schema as S
from shelfwise.plans.refresh import Lakehouse

PREDICTIONS_TABLE = "gold.stockout_predictions"
BRONZE_TABLE = "bronze.raw_events"


def declare_table(
    spark: SparkSession, name: str, columns: T.StructType, partition_by: tuple[str, ...] = (), location: str | None = None
) -> None:
    """Create the table and its namespace if they are not there; a table of other columns or types is refused."""
    namespace, _, _ = name.rpartition(".")
    if namespace:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{parts}{place}")
    there = [(f.name, f.dataType) for f in spark.table(name).schema.fields]
    wanted = [(f.name, f.dataType) for f in columns.fields if f.name not in partition_by]
    wanted += [(name, columns[name].dataType) for name in partition_by]
    if there != wanted:
        raise TypeError(f"{name} has the columns {there}, not {wanted}")


def replace_rows(df: DataFrame, name: str) -> None:
    """Replace the rows of a declared table; columns go by name, and a value that its type cannot hold fails."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)


def append_rows(df: DataFrame, name: str) -> None:
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def save_predictions(tables: Lakehouse, name: str = PREDICTIONS_TABLE, location: str | None = None) -> None:
    """The predictions of a run as rows of a declared table, in place of those of the last run."""
    declare_table(tables.spark, name, S.PREDICTIONS_SCHEMA, location=location)
    replace_rows(tables.stockout_predictions, name)


def save_bronze(spark: SparkSession, bronze: DataFrame, name: str = BRONZE_TABLE, location: str | None = None) -> None:
    """Bronze rows as rows of a declared table of load time and event, after those that it has."""
    declare_table(spark, name, S.BRONZE_SCHEMA, location=location)
    append_rows(bronze, name)

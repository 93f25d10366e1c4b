"""The incremental refresh: new Bronze rows brought into tables that exist already, by the days they touch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schema as S
from shelfwise.operators.silver import cast_failures, silver_events
from shelfwise.plans.refresh import Lakehouse, by_day, dimension_tables, write_facts_and_features
from shelfwise.sources.tables import exists, overwrite_partitions

BATCH = "batch"


def update(
    spark: SparkSession,
    bronze: str,
    out: str,
    checkpoint: str,
    on_cast_error: str = "raise",
    threshold: int = S.LOW_STOCK_THRESHOLD,
    max_bytes_per_trigger: int | None = S.MAX_LOAD_BYTES,
) -> Lakehouse:
    """Bring what Bronze has gained since the last run into the tables below ``out``, and return them.

    The tables hold what a full refresh of the whole Bronze would, but only days that have new
    events are computed and written again, however late these come; files of other days stay as they
    are, and so do the events that Silver has. ``checkpoint`` remembers which Bronze files
    were brought in. The first run builds the tables. See ``apply_batch`` for what happens to a batch.
    """
    tables = Lakehouse(spark, out)
    options = {"maxFileAge": S.REMEMBER_FILES}
    if max_bytes_per_trigger is not None:
        options["maxBytesPerTrigger"] = str(max_bytes_per_trigger)
    stream = spark.readStream.schema(S.BRONZE_LOG_SCHEMA).options(**options).parquet(bronze)
    query = (
        stream.where("status = 'loaded'")
        .select("ingested_at", "event")
        .writeStream.foreachBatch(lambda rows, number: apply_batch(tables, rows, number, on_cast_error, threshold))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not exists(spark, tables.path("gold.features_daily")):
        apply_batch(tables, spark.createDataFrame([], S.BRONZE_SCHEMA), -1, on_cast_error, threshold)
    return tables


def apply_batch(
    tables: Lakehouse, bronze: DataFrame, number: int, on_cast_error: str = "raise", threshold: int = S.LOW_STOCK_THRESHOLD
) -> None:
    """Add one batch of Bronze rows to the tables.

    Silver and the dimensions keep each batch in partitions of its own; facts and features are
    replaced for the days of the batch, from all of Silver's events of these days. Every
    write replaces the partitions it writes, so a batch that was cut off can be given again under
    its number and leaves what one run would have.
    """
    events = by_day(silver_events(bronze, on_cast_error), "event_type", "event_date")
    overwrite_partitions(_numbered(events, number), tables.path("silver.events"), ("event_type", "event_date", BATCH))
    if on_cast_error == "quarantine":
        overwrite_partitions(_numbered(cast_failures(bronze), number), tables.path("silver.cast_failures"), (BATCH,))
    _add_members(tables, bronze, number, on_cast_error)

    silver = tables.spark.read.schema(f"{S.SILVER_EVENTS_SCHEMA.toDDL()}, {BATCH} BIGINT").parquet(tables.path("silver.events"))
    # Read from the folders' names; no more than the days there are come to the driver.
    days = [row[0] for row in silver.where(F.col(BATCH) == number).select("event_date").distinct().collect()]
    if not days:
        return _declare_empty(tables, threshold)
    touched = on_days(F.col("event_date"), days)
    write_facts_and_features(
        tables.sales_events.where(touched),
        tables.inventory_events.where(touched),
        threshold,
        lambda df, table: overwrite_partitions(by_day(df, "date"), tables.path(table), ("date",)),
    )


def on_days(column: Column, days: Sequence[date | None]) -> Column:
    """Whether the date is one of the days; None stands for rows without a date."""
    some = column.isin([day for day in days if day is not None])
    return F.coalesce(some, F.lit(False)) | column.isNull() if None in days else some


def _numbered(df: DataFrame, number: int) -> DataFrame:
    return df.withColumn(BATCH, F.lit(number).cast("bigint"))


def _add_members(tables: Lakehouse, bronze: DataFrame, number: int, on_cast_error: str) -> None:
    """Dimension members that no earlier batch has; a member that is a JSON null counts once too."""
    for table, members in dimension_tables(bronze, on_cast_error):
        path = tables.path(table)
        if exists(tables.spark, path):
            schema = f"{members.schema.toDDL()}, {BATCH} BIGINT"
            old = tables.spark.read.schema(schema).parquet(path).where(F.col(BATCH) < number).drop(BATCH)
            members = members.subtract(old)
        overwrite_partitions(_numbered(members, number), path, (BATCH,))


def _declare_empty(tables: Lakehouse, threshold: int) -> None:
    """A first batch without a sale or a reading still leaves tables that can be read."""
    write_facts_and_features(
        tables.sales_events.limit(0),
        tables.inventory_events.limit(0),
        threshold,
        lambda df, table: overwrite_partitions(df, tables.path(table), ("date",)),
    )

"""The full refresh from Bronze to features, and the prediction job after it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import schema as S
from shelfwise.operators import dimensions as D
from shelfwise.operators.facts import fact_inventory_daily, fact_sales_daily
from shelfwise.operators.features import features_daily
from shelfwise.operators.silver import cast_failures, silver_events
from shelfwise.operators.stockout import (
    StockoutModel,
    predictions,
    score,
    train_stockout,
    training_set,
)
from shelfwise.sources.tables import exists, full_refresh, read_table


@dataclass(frozen=True)
class Lakehouse:
    """The Silver and Gold tables of one refresh, all below ``root``."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    def _read(self, table: str, schema) -> DataFrame:
        return read_table(self.spark, self.path(table), schema)

    def _silver(self, kind: str, schema) -> DataFrame:
        events = self._read("silver.events", S.SILVER_EVENTS_SCHEMA)
        return events.where(F.col("event_type") == kind).select(*schema.fieldNames())

    @property
    def sales_events(self) -> DataFrame:
        return self._silver(S.SALE, S.SALES_EVENTS_SCHEMA)

    @property
    def inventory_events(self) -> DataFrame:
        return self._silver(S.INVENTORY, S.INVENTORY_EVENTS_SCHEMA)

    @property
    def cast_failures(self) -> DataFrame:
        """Bronze rows left out by a refresh in quarantine mode."""
        return self._read("silver.cast_failures", S.BRONZE_SCHEMA)

    @property
    def dim_date(self) -> DataFrame:
        return self._read("gold.dim_date", S.DIM_DATE_SCHEMA)

    @property
    def dim_store(self) -> DataFrame:
        return self._read("gold.dim_store", S.DIM_STORE_SCHEMA)

    @property
    def dim_product(self) -> DataFrame:
        return self._read("gold.dim_product", S.DIM_PRODUCT_SCHEMA)

    @property
    def fact_sales_daily(self) -> DataFrame:
        return self._read("gold.fact_sales_daily", S.FACT_SALES_SCHEMA)

    @property
    def fact_inventory_daily(self) -> DataFrame:
        return self._read("gold.fact_inventory_daily", S.FACT_INVENTORY_SCHEMA)

    @property
    def features_daily(self) -> DataFrame:
        return self._read("gold.features_daily", S.FEATURES_SCHEMA)

    @property
    def stockout_predictions(self) -> DataFrame:
        return self._read("gold.stockout_predictions", S.PREDICTIONS_SCHEMA)

    @property
    def stockout_predictions_keyed(self) -> DataFrame:
        return self._read("gold.stockout_predictions_keyed", S.KEYED_PREDICTIONS_SCHEMA)


def refresh(
    spark: SparkSession,
    bronze: DataFrame,
    out: str,
    on_cast_error: str = "raise",
    threshold: int = S.LOW_STOCK_THRESHOLD,
    overwrite: bool = False,
) -> Lakehouse:
    """Rebuild Silver, dimensions, facts and features, in this order, below ``out``.

    Each step reads what the one before it wrote, and the first failure stops the
    chain. Bronze is scanned once for both Silver tables, and once for the one field of
    each dimension. Facts read Silver, where each kind and day is its own partition; facts
    and features are partitioned by day, so one day can be read alone. Give every run a
    new ``out`` and switch readers with ``publish_views``: a folder that holds a run
    already is refused, unless ``overwrite`` says that nobody reads it.

    A value that cannot be cast fails the refresh. With ``on_cast_error`` set to
    ``quarantine`` its event goes to ``cast_failures`` instead, from one more scan.
    """
    tables = Lakehouse(spark, out)
    if not overwrite and exists(spark, tables.path("silver.events")):
        raise FileExistsError(f"{out} holds a run already; give each run a new folder, or set overwrite")

    full_refresh(
        by_day(silver_events(bronze, on_cast_error), "event_type", "event_date"),
        tables.path("silver.events"),
        ("event_type", "event_date"),
    )

    if on_cast_error == "quarantine":
        full_refresh(cast_failures(bronze), tables.path("silver.cast_failures"))

    for table, members in dimension_tables(bronze, on_cast_error):
        full_refresh(members, tables.path(table))

    write_facts_and_features(
        tables.sales_events,
        tables.inventory_events,
        threshold,
        lambda df, table: full_refresh(by_day(df, "date"), tables.path(table), ("date",)),
    )
    return tables


def dimension_tables(bronze: DataFrame, on_cast_error: str) -> list[tuple[str, DataFrame]]:
    """The three dimensions, each from a scan of its own that reads one field of the events.

    Together they read what one scan for all of them would; that one has to carry every event
    three times, and took more than twice as long.
    """
    return [
        ("gold.dim_date", D.dim_date(bronze, on_cast_error=on_cast_error)),
        ("gold.dim_store", D.dim_store(bronze)),
        ("gold.dim_product", D.dim_product(bronze)),
    ]


def write_facts_and_features(
    sales_events: DataFrame, inventory_events: DataFrame, threshold: int, write: Callable[[DataFrame, str], None]
) -> None:
    """Compute both facts once, write them, and write the features joined from the same rows.

    The facts are kept, in memory or on the executors' disks, in the partitioning by their
    keys in which they were computed, the same for both. So the join shuffles neither; read back
    from their day folders, both would be shuffled once more. A lost executor's part is computed again.
    """
    with _same_partitions(sales_events.sparkSession):
        sales = fact_sales_daily(sales_events).persist(StorageLevel.MEMORY_AND_DISK)
        inventory = fact_inventory_daily(inventory_events).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write(sales, "gold.fact_sales_daily")
            write(inventory, "gold.fact_inventory_daily")
            write(features_daily(sales, inventory, threshold), "gold.features_daily")
        finally:
            sales.unpersist()
            inventory.unpersist()


@contextmanager
def _same_partitions(spark: SparkSession) -> Iterator[None]:
    """Rows kept here stay in as many partitions as the session's shuffles start from."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    settings = {"spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "false"}
    if first is not None:
        settings["spark.sql.shuffle.partitions"] = first
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def by_day(df: DataFrame, *names: str) -> DataFrame:
    """The rows of a day brought together, so that it has few files; Spark splits large days by size."""
    return df.hint("rebalance", *names)


def predict_stockouts(
    tables: Lakehouse, c: float = 1.0, missing_inventory: str = "zero", keep_keys: bool = False
) -> StockoutModel:
    """Train on the feature table, score the same rows and rewrite the prediction table.

    ``keep_keys`` writes ``gold.stockout_predictions_keyed`` beside it, the same rows with
    their date, store and product.
    """
    training = training_set(tables.features_daily, missing_inventory, keep_keys=True)
    model = train_stockout(training, c)
    scored = score(training, model)
    full_refresh(predictions(scored), tables.path("gold.stockout_predictions"))
    if keep_keys:
        full_refresh(predictions(scored, keep_keys=True), tables.path("gold.stockout_predictions_keyed"))
    return model

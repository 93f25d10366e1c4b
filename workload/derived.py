"""Retail events derived from the given tables.

Purchases become sales and views become stock readings; every other event keeps
its kind and reaches the dimensions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import encode_json, iso_utc
from shelfwise.operators import parse_lines
from shelfwise.schema import EVENT_FIELDS, INVENTORY, NUMBER, SALE
from shelfwise.session import shared_dir
from shelfwise.sources.raw_files import scan_raw
from shelfwise.sources.tables import read_bronze, write_bronze

# Fixed values.
PRODUCTS = ("milk", "bread", "eggs", "soap", "shampoo")
# The kind whose lines are cut short where a query needs malformed input.
BROKEN_KIND = "error"
# Sales above this quantity get a quantity that is no number, where a query needs one.
READABLE_QTY = 3


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def retail_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event fields as they go into JSON, with the id and time they came from."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = (
        F.when(F.col("event_type") == "purchase", SALE)
        .when(F.col("event_type") == "view", INVENTORY)
        .otherwise(F.col("event_type"))
    )
    product = F.element_at(
        F.array(*[F.lit(name) for name in PRODUCTS]), (F.col("event_id") % 5 + 1).cast("int")
    )
    return read(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        kind.alias("event_type"),
        iso_utc(F.col("ts")).alias("event_time"),
        F.to_date("ts").cast("string").alias("event_date"),
        F.concat(F.lit("store_"), F.col("user_id") % 3 + 1).alias("store_id"),
        product.alias("product_id"),
        F.when(kind == SALE, k % 4 + 1).alias("qty"),
        F.when(kind == INVENTORY, k % 21).alias("on_hand"),
    )


def json_lines(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", encode_json(*EVENT_FIELDS).alias("value"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_lines(retail_events(spark, sf_dir))


def raw_lines_with_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines, with the lines of one kind cut short by their closing brace."""
    whole = encode_json(*EVENT_FIELDS)
    cut = F.when(F.col("event_type") == BROKEN_KIND, F.rtrim(whole, F.lit("}"))).otherwise(whole)
    return retail_events(spark, sf_dir).select("event_id", "ts", cut.alias("value"))


def raw_lines_with_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines, with the word "many" for every quantity above ``READABLE_QTY``."""
    qty = F.when(F.col("qty") > READABLE_QTY, F.lit("many"))
    events = retail_events(spark, sf_dir)
    return json_lines(events.withColumn("qty", F.coalesce(qty, F.col("qty").cast("string"))))


def untidy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event fields as JSON text, untidy in the ways that other producers are.

    The rest of the event's number by a small prime decides: a store or product that is
    a JSON null or missing, a quantity or stock that is a text, a fraction, a null or missing, a
    time with another offset, cut to seconds, a null or missing, and a date that is a null, empty
    or missing.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    n = F.col("event_id")

    def one_of(prime: int, default: Column, *others: Column) -> Column:
        """The others for the first remainders, the default for all that follow."""
        rest, column = n % prime, default
        for i, other in enumerate(others):
            column = F.when(rest == i, other).otherwise(column)
        return column

    missing, null = F.lit(None).cast("string"), F.lit("null")
    quote = lambda column: F.concat(F.lit('"'), column, F.lit('"'))
    time = iso_utc(F.col("ts"))
    kind = (
        F.when(F.col("event_type") == "purchase", SALE)
        .when(F.col("event_type") == "view", INVENTORY)
        .otherwise(F.col("event_type"))
    )
    store = quote(F.concat(F.lit("store_"), F.col("user_id") % 3 + 1))
    product = quote(F.element_at(F.array(*[F.lit(p) for p in PRODUCTS]), (n % 5 + 1).cast("int")))
    number = (k % 4 + 1).cast("string")
    stock = (k % 21).cast("string")
    # A few times for many readings, so that readings tie.
    hour = quote(F.concat(F.substring(time, 1, 13), F.lit(":00:00+00:00")))
    moved = quote(F.concat(F.substring(time, 1, 26), F.lit("+05:30")))
    return read(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        quote(kind).alias("event_type"),
        F.when(kind == INVENTORY, one_of(11, hour, null, missing)).otherwise(one_of(11, quote(time), moved, null)).alias("event_time"),
        one_of(13, quote(F.to_date("ts").cast("string")), null, missing, F.lit('""')).alias("event_date"),
        one_of(7, store, null, missing).alias("store_id"),
        one_of(17, product, missing, null).alias("product_id"),
        F.when(kind == SALE, one_of(5, number, quote(number), F.concat(number, F.lit(".5")), null)).alias("qty"),
        F.when(kind == INVENTORY, one_of(19, stock, quote(stock), null, missing)).alias("on_hand"),
    )


def _joined(events: DataFrame) -> DataFrame:
    """Fields of JSON text as lines; a missing field is left out."""
    pairs = [F.concat(F.lit(f'"{name}":'), F.col(name)) for name in EVENT_FIELDS]
    value = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
    return events.select("event_id", "ts", value.alias("value"))


def untidy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(untidy_events(spark, sf_dir))


def untidy_dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The untidy lines without dates that are an empty text, so that every date can be cast."""
    date = F.col("event_date")
    return _joined(untidy_events(spark, sf_dir).withColumn("event_date", F.when(date != '""', date)))


def spoilt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines, most of them spoilt, each in one of seven ways or not at all.

    Of these a lone number, a list and two documents on one line are JSON or nearly so.
    """
    whole = F.col("value")
    half = F.substring(whole, 1, 25)
    ways = [
        whole,
        F.rtrim(whole, F.lit("}")),
        half,
        F.concat(whole, F.lit("}")),
        F.concat(F.lit("[1,"), whole, F.lit("]")),
        F.col("event_id").cast("string"),
        F.concat(whole, whole),
        F.concat(F.lit("x"), whole),
    ]
    column = ways[0]
    for i, way in enumerate(ways[1:], 1):
        column = F.when(F.col("event_id") % len(ways) == i, way).otherwise(column)
    return raw_lines(spark, sf_dir).withColumn("value", column)


Lines = Callable[[SparkSession, str], DataFrame]


def raw_files(spark: SparkSession, sf_dir: str, lines: Lines = raw_lines) -> DataFrame:
    """The derived lines, written as files of text and read back line by line."""
    path = shared_dir(spark, f"raw-{lines.__name__}")
    lines(spark, sf_dir).select("value").write.text(path)
    return scan_raw(spark, path)


def bronze(spark: SparkSession, sf_dir: str, lines: Lines = raw_lines) -> DataFrame:
    """The derived lines as a Bronze table, as the operators after it find them.

    Every call derives, writes, parses and loads anew.
    """
    path = shared_dir(spark, f"bronze-{lines.__name__}")
    write_bronze(parse_lines(raw_files(spark, sf_dir, lines)), path)
    return read_bronze(spark, path)


def lineitem_sales(spark: SparkSession, sf_dir: str, store: str, product: str) -> DataFrame:
    """Line items as sales of a store and a product."""
    return _lineitem(read(spark, sf_dir, "lineitem"), store, product, "qty")


def lineitem_readings(spark: SparkSession, sf_dir: str, store: str, product: str) -> DataFrame:
    """Line items as stock readings; many share a key and a time."""
    return _lineitem(read(spark, sf_dir, "lineitem"), store, product, "on_hand")


def _lineitem(items: DataFrame, store: str, product: str, quantity: str) -> DataFrame:
    return items.select(
        F.col("l_shipdate").alias("event_time"),
        F.to_date("l_shipdate").alias("event_date"),
        F.col(store).cast("string").alias("store_id"),
        F.col(product).cast("string").alias("product_id"),
        F.col("l_quantity").cast(NUMBER).alias(quantity),
    )


def as_bigint(df: DataFrame, *names: str) -> DataFrame:
    """Whole-number decimals as bigint, for comparison."""

    def cast(name: str) -> Column:
        return F.col(name).cast("bigint").alias(name) if name in names else F.col(name)

    return df.select(*[cast(name) for name in df.columns])

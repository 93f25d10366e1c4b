"""One query per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise import Lakehouse, predict_stockouts, refresh, shared_dir, update
from shelfwise import operators as O
from shelfwise.functions import date_path, encode_json, field, field_or_null, iso_utc, parse_event
from shelfwise.plans import open_run, publish_run, save_bronze, save_predictions
from shelfwise.schema import EVENT_FIELDS, FEATURE_COLUMNS, LABEL_COLUMN, PROBABILITY_COLUMN, SALE
from shelfwise.sources import full_refresh, read_bronze, read_rejects, scan_raw
from shelfwise.streaming import (
    encode_events,
    land_raw,
    landed_lines,
    load_bronze,
    load_files,
    quarantined_lines,
    undated_lines,
)
from workload import derived as W

Query = Callable[[SparkSession, str], DataFrame]

# A model with stated weights, so that scores can be checked without training.
FIXED_MODEL = O.StockoutModel((-0.005, -0.036, -1.284), 2.887, 0)
# Decimals kept of trained weights and probabilities in compared results.
TRAINED_DECIMALS = 5
SCORED_DECIMALS = 6


def _typed(bronze: DataFrame) -> DataFrame:
    return W.as_bigint(bronze.select(*[field(name) for name in EVENT_FIELDS]), "qty", "on_hand")


# --- messages, landing, Bronze -------------------------------------------------


def publish_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as published, as text."""
    events = W.retail_events(spark, sf_dir)
    return encode_events(events).select(F.decode("value", "UTF-8").alias("message"))


def publish_encode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages decoded again and typed."""
    messages = encode_events(W.retail_events(spark, sf_dir))
    return _typed(messages.select(parse_event(F.decode("value", "UTF-8")).alias("event")))


def bronze_events_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(W.bronze(spark, sf_dir))


def bronze_parse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines parsed and typed in one plan, without a table in between."""
    return _typed(O.bronze_events(O.parse_lines(W.raw_files(spark, sf_dir))))


def bronze_load_skip_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(W.bronze(spark, sf_dir, W.raw_lines_with_broken))


def bronze_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = O.parse_lines(W.raw_files(spark, sf_dir, W.raw_lines_with_broken))
    return O.rejected_lines(parsed).select("line")


def _write_files(lines: DataFrame, path: str) -> None:
    """Raw files of JSON lines in a date tree, as a landing job leaves them."""
    dated = lines.select(*date_path(F.to_date("ts")), "value")
    dated.write.mode("append").partitionBy("y", "m", "d").text(path)


def _load_in_steps(spark: SparkSession, lines: DataFrame) -> str:
    """Load the days up to the middle of the given time, the same files again, then all files."""
    work = shared_dir(spark, "bronze-load")
    days = lines.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last"))
    middle = days.select(F.date_add("first", F.ceil(F.datediff("last", "first") / 2).cast("int"))).first()[0]

    def load() -> None:
        load_bronze(spark, f"{work}/raw", f"{work}/bronze", f"{work}/checkpoint").awaitTermination()

    early = F.to_date("ts") < F.lit(middle)
    _write_files(lines.where(early), f"{work}/raw")
    load()
    load()
    _write_files(lines.where(~early), f"{work}/raw")
    load()
    return f"{work}/bronze"


def bronze_incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = W.raw_lines_with_broken(spark, sf_dir)
    return _typed(read_bronze(spark, _load_in_steps(spark, lines)))


def bronze_incremental_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines, with the day in the path of the file each came from."""
    lines = W.raw_lines_with_broken(spark, sf_dir)
    day = F.regexp_extract("source_file", "/y=(\\d+)/m=(\\d+)/d=(\\d+)/", 3).cast("int")
    return read_rejects(spark, _load_in_steps(spark, lines)).select("line", day.alias("day"))


def _load_files_in_steps(spark: SparkSession, lines: DataFrame) -> str:
    """The same days in the same steps, with the names of loaded files in a table."""
    work = shared_dir(spark, "file-load")
    days = lines.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last"))
    middle = days.select(F.date_add("first", F.ceil(F.datediff("last", "first") / 2).cast("int"))).first()[0]
    early = F.to_date("ts") < F.lit(middle)
    for some in (early, F.lit(False), ~early):
        _write_files(lines.where(some), f"{work}/raw")
        load_files(spark, f"{work}/raw", f"{work}/bronze", f"{work}/log")
    return f"{work}/bronze"


def bronze_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(read_bronze(spark, _load_files_in_steps(spark, W.raw_lines_with_broken(spark, sf_dir))))


def bronze_file_load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines, with the day in the path of the file each came from."""
    day = F.regexp_extract("source_file", "/y=(\\d+)/m=(\\d+)/d=(\\d+)/", 3).cast("int")
    bronze = _load_files_in_steps(spark, W.raw_lines_with_broken(spark, sf_dir))
    return read_rejects(spark, bronze).select("line", day.alias("day"))


def raw_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the dated text files; other names and other folders hold more, and are passed over."""
    path = f"{shared_dir(spark, 'raw')}/raw"
    lines = W.raw_lines(spark, sf_dir)
    _write_files(lines, f"{path}/events")
    _write_files(lines.withColumn("value", F.lit("of another folder")), f"{path}/notes")
    lines.select(F.lit("of another name")).write.csv(f"{path}/events/csv")
    found = scan_raw(spark, path, name_glob="*.txt", path_regex=r"/events/y=\d+/m=\d+/d=\d+/")
    return found.select(F.col("value").alias("line"))


def _landed(spark: SparkSession, lines: DataFrame) -> str:
    """The lines landed from a stream of message files."""
    work = shared_dir(spark, "landing")
    lines.select(F.encode("value", "UTF-8").alias("value")).write.parquet(f"{work}/messages")
    messages = spark.readStream.schema("value binary").parquet(f"{work}/messages")
    land_raw(
        messages, f"{work}/landed", f"{work}/checkpoint", trigger={"availableNow": True}
    ).awaitTermination()
    return f"{work}/landed"


def raw_landing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landed_lines(spark, _landed(spark, W.raw_lines(spark, sf_dir)))
    return landed.groupBy("y", "m", "d").agg(F.count(F.lit(1)).alias("line_count"))


def raw_landing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = landed_lines(spark, _landed(spark, W.raw_lines_with_broken(spark, sf_dir)))
    return landed.select("y", "m", "d", F.col("value").alias("line"))


def raw_landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _landed(spark, W.raw_lines_with_broken(spark, sf_dir))
    return quarantined_lines(spark, out).select(F.col("value").alias("line"))


# --- untidy values -------------------------------------------------------------


def untidy_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines spoilt in several ways that are no JSON document."""
    return O.rejected_lines(O.parse_lines(W.raw_files(spark, sf_dir, W.spoilt_lines))).select("line")


def untidy_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines landed, by what became of them; the day is left out where it is that of the run."""
    out = _landed(spark, W.untidy_lines(spark, sf_dir).unionByName(W.spoilt_lines(spark, sf_dir)))
    line = F.col("value").alias("line")
    landed = landed_lines(spark, out)
    own = F.substring(F.get_json_object("value", "$.event_date"), 1, 10)
    filed = F.concat_ws("-", "y", "m", "d")
    return (
        landed.select(F.lit("landed").alias("state"), line, F.coalesce(filed == own, F.lit(False)).alias("under_own_date"))
        .unionAll(quarantined_lines(spark, out).select(F.lit("quarantined"), line, F.lit(False)))
        .unionAll(undated_lines(spark, out).select(F.lit("undated"), line, F.lit(False)))
    )


def landing_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose date cannot be read are filed apart."""
    lines = W.raw_lines(spark, sf_dir)
    wrong = F.regexp_replace("value", '"event_date":"[^"]*"', '"event_date":"someday"')
    spoilt = lines.withColumn("value", F.when(F.col("event_id") % 3 == 0, wrong).otherwise(F.col("value")))
    return undated_lines(spark, _landed(spark, spoilt)).select(F.col("value").alias("line"))


def untidy_silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(O.silver_sales(W.bronze(spark, sf_dir, W.untidy_dated_lines)), "qty")


def untidy_dimension_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON nulls are members, missing fields are not."""
    return O.dimension_members(W.bronze(spark, sf_dir, W.untidy_dated_lines))


def untidy_dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.dim_store(W.bronze(spark, sf_dir, W.untidy_dated_lines))


def untidy_fact_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a time, and many that tie."""
    readings = O.silver_inventory(W.bronze(spark, sf_dir, W.untidy_dated_lines))
    return W.as_bigint(O.fact_inventory_daily(readings), "on_hand_latest")


def bronze_ingested_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every event was loaded at one time that lies between the call and the answer, in UTC."""
    before = F.lit(datetime.now(UTC).replace(tzinfo=None) - timedelta(seconds=1)).cast("timestamp_ntz")
    loaded = W.bronze(spark, sf_dir)
    now = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    return loaded.agg(
        F.count(F.lit(1)).alias("events"),
        F.bool_and((F.col("ingested_at") >= before) & (F.col("ingested_at") <= now)).alias("in_time"),
    )


# --- Silver --------------------------------------------------------------------


def silver_sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(O.silver_sales(W.bronze(spark, sf_dir)), "qty")


def silver_inventory_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(O.silver_inventory(W.bronze(spark, sf_dir)), "on_hand")


def silver_events_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(O.silver_events(W.bronze(spark, sf_dir)), "qty", "on_hand")


def silver_sales_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of readable quantity where some quantities are words."""
    bronze = W.bronze(spark, sf_dir, W.raw_lines_with_bad_values)
    return W.as_bigint(O.silver_sales(bronze, on_cast_error="quarantine"), "qty")


def silver_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = O.cast_failures(W.bronze(spark, sf_dir, W.raw_lines_with_bad_values))
    return failures.select(
        field("event_time"),
        field("store_id"),
        field("product_id"),
        F.variant_get("event", "$.qty", "string").alias("qty_text"),
        field_or_null("qty").cast("bigint").alias("qty"),
    )


# --- Gold ----------------------------------------------------------------------


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.dim_date(W.bronze(spark, sf_dir))


def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.dim_store(W.bronze(spark, sf_dir))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.dim_product(W.bronze(spark, sf_dir))


def dimension_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three dimensions from one pass."""
    return O.dimension_members(W.bronze(spark, sf_dir))


def _sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.fact_sales_daily(O.silver_sales(W.bronze(spark, sf_dir)))


def _inventory_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.fact_inventory_daily(O.silver_inventory(W.bronze(spark, sf_dir)))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.features_daily(_sales_fact(spark, sf_dir), _inventory_fact(spark, sf_dir))


def fact_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(_sales_fact(spark, sf_dir), "total_qty_sold")


def fact_inventory_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(_inventory_fact(spark, sf_dir), "on_hand_latest")


def features_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(_features(spark, sf_dir), "total_qty_sold", "on_hand_latest")


def recent_sales_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.as_bigint(O.recent_sales(_sales_fact(spark, sf_dir)), "total_qty_sold")


# --- model ---------------------------------------------------------------------


def _rounded(df: DataFrame, decimals: int) -> DataFrame:
    return df.withColumn(PROBABILITY_COLUMN, F.round(PROBABILITY_COLUMN, decimals))


def _whole(df: DataFrame) -> DataFrame:
    return W.as_bigint(df, *FEATURE_COLUMNS, LABEL_COLUMN)


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _whole(O.training_set(_features(spark, sf_dir)))


def training_set_with_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a stock reading only, with their keys."""
    features = _features(spark, sf_dir)
    return _whole(O.training_set(features, missing_inventory="drop", keep_keys=True))


def stockout_score_fixed_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = O.training_set(_features(spark, sf_dir), keep_keys=True)
    scored = O.predictions(O.score(training, FIXED_MODEL), keep_keys=True)
    return _rounded(_whole(scored), SCORED_DECIMALS)


def riskiest_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = O.score(O.training_set(_features(spark, sf_dir)), FIXED_MODEL)
    return _rounded(_whole(O.riskiest(O.predictions(scored))), SCORED_DECIMALS)


def run_report_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run: its rows of highest risk, with the number of rows used."""
    scored = O.score(O.training_set(_features(spark, sf_dir)), FIXED_MODEL)
    rows, top = O.run_report(scored)
    return _rounded(_whole(top), SCORED_DECIMALS).withColumn("rows_used", F.lit(rows).cast("bigint"))


def stockout_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trained weights, one row each."""
    training = O.training_set(_features(spark, sf_dir))
    model = O.train_stockout(training)
    names = [*FEATURE_COLUMNS, "intercept"]
    weights = [*model.coefficients, model.intercept]
    return spark.range(1).select(
        F.lit(model.rows).cast("bigint").alias("row_count"),
        *[F.round(F.lit(w), TRAINED_DECIMALS).alias(n) for n, w in zip(names, weights, strict=True)],
    )


def _predicted(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> DataFrame:
    """Train on a written training table and score the same rows."""
    path = shared_dir(spark, "training")
    full_refresh(O.training_set(_features(spark, sf_dir), keep_keys=keep_keys), path)
    training = spark.read.parquet(path)
    scored = O.score(training, O.train_stockout(training))
    return _rounded(_whole(O.predictions(scored, keep_keys)), TRAINED_DECIMALS)


def stockout_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predicted(spark, sf_dir)


def stockout_predictions_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predicted(spark, sf_dir, keep_keys=True)


# --- whole jobs ----------------------------------------------------------------


def _refreshed(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Messages landed, loaded into Bronze and refreshed into all tables."""
    landed = _landed(spark, W.raw_lines(spark, sf_dir))
    work = shared_dir(spark, "refresh")
    load_bronze(spark, landed, f"{work}/bronze", f"{work}/checkpoint").awaitTermination()
    return refresh(spark, read_bronze(spark, f"{work}/bronze"), f"{work}/tables")


def refresh_features_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _refreshed(spark, sf_dir).features_daily
    return W.as_bigint(features, "total_qty_sold", "on_hand_latest")


def refresh_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From messages to the written prediction table."""
    tables = _refreshed(spark, sf_dir)
    predict_stockouts(tables)
    return _rounded(_whole(tables.stockout_predictions), TRAINED_DECIMALS)


def refresh_current_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with the members of all dimensions, joined by name in a run that is no longer the newest."""
    bronze, work = W.bronze(spark, sf_dir), shared_dir(spark, "runs")
    session = spark.newSession()
    publish_run(refresh(spark, bronze, f"{work}/0"), f"{work}/runs")
    open_run(session, f"{work}/runs")
    publish_run(refresh(spark, bronze.limit(0), f"{work}/1"), f"{work}/runs")
    return session.sql(
        "SELECT f.date, d.day_of_week, f.store_id, f.product_id, CAST(total_qty_sold AS BIGINT) AS total_qty_sold,"
        " sales_event_count, CAST(on_hand_latest AS BIGINT) AS on_hand_latest, stockout_risk_label FROM features_daily f"
        " JOIN dim_date d ON d.date = f.date JOIN dim_store USING (store_id) JOIN dim_product USING (product_id)"
    )


def _namespace(spark: SparkSession, purpose: str) -> str:
    """A namespace of its own for each call, with its tables below the shared folder."""
    path = shared_dir(spark, purpose)
    name = path.rpartition("/")[2].replace("-", "_")
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{path}'")
    return name


def predictions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predictions of a run, read by name from a table of declared types."""
    tables = refresh(spark, W.bronze(spark, sf_dir), f"{shared_dir(spark, 'refresh')}/tables")
    predict_stockouts(tables)
    name = f"{_namespace(spark, 'gold')}.stockout_predictions"
    save_predictions(tables, name)
    save_predictions(tables, name)
    return _rounded(_whole(spark.table(name)), TRAINED_DECIMALS)


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events loaded twice into a table of declared types, in two halves, and read by name in SQL."""
    bronze, name = W.bronze(spark, sf_dir), f"{_namespace(spark, 'bronze')}.raw_events"
    sale = F.coalesce(field("event_type") == SALE, F.lit(False))
    for half in (sale, ~sale):
        save_bronze(spark, bronze.where(half), name)
    fields = ", ".join(f"event:{f}::{kind} AS {f}" for f, kind in EVENT_FIELDS.items())
    return W.as_bigint(spark.sql(f"SELECT {fields} FROM {name}"), "qty", "on_hand")


def _updated(spark: SparkSession, sf_dir: str, lines: W.Lines) -> Lakehouse:
    """Tables brought up to date three times: with the days before the middle, those after it, and late events of all days.

    Each time the new lines are written as files, loaded into Bronze, and brought in from there.
    """
    work = shared_dir(spark, "update")
    every = lines(spark, sf_dir)
    day = F.to_date("ts")
    span = every.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    middle = span.select(F.date_add("first", F.ceil(F.datediff("last", "first") / 2).cast("int"))).first()[0]
    late, early = F.col("event_id") % 3 == 0, day < F.lit(middle)
    for some in (early & ~late, ~early & ~late, late):
        every.where(some).select("value").write.mode("append").text(f"{work}/raw")
        load_bronze(spark, f"{work}/raw", f"{work}/bronze", f"{work}/loaded").awaitTermination()
        tables = update(spark, f"{work}/bronze", f"{work}/tables", f"{work}/updated")
    return tables


def update_features_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _updated(spark, sf_dir, W.raw_lines).features_daily
    return W.as_bigint(features, "total_qty_sold", "on_hand_latest")


def update_untidy_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a date or time, and many that tie, brought in by and by."""
    return W.as_bigint(_updated(spark, sf_dir, W.untidy_dated_lines).fact_inventory_daily, "on_hand_latest")


def update_untidy_dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members come once, whichever update had them first; a JSON null is one."""
    return _updated(spark, sf_dir, W.untidy_dated_lines).dim_store


# --- the same operators on larger tables ---------------------------------------


def lineitem_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = W.lineitem_sales(spark, sf_dir, store="l_suppkey", product="l_partkey")
    return W.as_bigint(O.fact_sales_daily(sales), "total_qty_sold")


def lineitem_inventory_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = W.lineitem_readings(spark, sf_dir, store="l_suppkey", product="l_linenumber")
    return W.as_bigint(O.fact_inventory_daily(readings), "on_hand_latest")


def lineitem_features_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"store": "l_linestatus", "product": "l_linenumber"}
    sales = O.fact_sales_daily(W.lineitem_sales(spark, sf_dir, **keys))
    stock = O.fact_inventory_daily(W.lineitem_readings(spark, sf_dir, **keys))
    return W.as_bigint(O.features_daily(sales, stock), "total_qty_sold", "on_hand_latest")


def lineitem_message_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sale messages, as text."""
    sales = W.lineitem_sales(spark, sf_dir, store="l_suppkey", product="l_partkey")
    events = sales.withColumn("event_time", iso_utc(F.col("event_time")))
    columns = ("event_time", "event_date", "store_id", "product_id", "qty")
    return events.select(encode_json(*columns).alias("message"))


def orders_latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = W.read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"
    )
    order = [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc()]
    return O.latest_per_key(orders, ["o_custkey"], order)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        publish_encode,
        publish_encode_roundtrip,
        raw_file_scan,
        raw_landing_partitions,
        raw_landing_lines,
        raw_landing_quarantine,
        bronze_events_typed,
        bronze_parse_lines,
        bronze_load_skip_malformed,
        bronze_rejected_lines,
        bronze_incremental_stream,
        bronze_incremental_rejects,
        silver_sales_events,
        silver_inventory_events,
        silver_events_one_pass,
        silver_sales_quarantined,
        silver_cast_failures,
        dim_date,
        dim_store,
        dim_product,
        dimension_members,
        fact_sales_daily,
        fact_inventory_daily,
        features_daily,
        recent_sales_top10,
        training_set,
        training_set_with_inventory,
        stockout_score_fixed_model,
        riskiest_top10,
        run_report_top10,
        stockout_model,
        stockout_predictions,
        stockout_predictions_keyed,
        refresh_features_daily,
        refresh_predictions,
        refresh_current_run,
        predictions_table,
        bronze_table,
        bronze_file_load,
        bronze_file_load_rejects,
        update_features_daily,
        update_untidy_inventory,
        update_untidy_dim_store,
        lineitem_sales_daily,
        lineitem_inventory_daily,
        lineitem_features_daily,
        lineitem_message_text,
        orders_latest_per_customer,
        untidy_rejected_lines,
        untidy_landing,
        landing_undated,
        untidy_silver_sales,
        untidy_dimension_members,
        untidy_dim_store,
        untidy_fact_inventory,
        bronze_ingested_at,
    )
}

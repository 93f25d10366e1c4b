"""The ordered refresh, the prediction job and the catalog views."""

import json
from datetime import date

import pytest

from shelfwise import predict_stockouts, publish_views, refresh, shared_dir
from shelfwise import operators as O
from shelfwise import schema as S
from shelfwise.sources import full_refresh
from shelfwise.sources.tables import write_bronze
from tests.conftest import rows
from tests.fixtures import SAMPLE_EVENTS

TABLES = (
    "sales_events",
    "inventory_events",
    "dim_date",
    "dim_store",
    "dim_product",
    "fact_sales_daily",
    "fact_inventory_daily",
    "features_daily",
)


def contents(tables):
    return {name: rows(getattr(tables, name)) for name in TABLES}


def test_refresh_writes_what_the_operators_compute(spark, edges, tmp_path):
    tables = refresh(spark, edges, str(tmp_path / "out"))
    sales, inventory = O.silver_sales(edges), O.silver_inventory(edges)
    facts = O.fact_sales_daily(sales), O.fact_inventory_daily(inventory)
    assert contents(tables) == {
        "sales_events": rows(sales),
        "inventory_events": rows(inventory),
        "dim_date": rows(O.dim_date(edges)),
        "dim_store": rows(O.dim_store(edges)),
        "dim_product": rows(O.dim_product(edges)),
        "fact_sales_daily": rows(facts[0]),
        "fact_inventory_daily": rows(facts[1]),
        "features_daily": rows(O.features_daily(*facts)),
    }


def test_refreshing_again_changes_nothing(spark, sample, tmp_path):
    first = contents(refresh(spark, sample, str(tmp_path / "out")))
    with pytest.raises(FileExistsError):
        refresh(spark, sample, str(tmp_path / "out"))
    assert contents(refresh(spark, sample, str(tmp_path / "out"), overwrite=True)) == first
    assert contents(refresh(spark, sample.repartition(7), str(tmp_path / "other"))) == first


def test_refresh_replaces_older_rows(spark, sample, edges, tmp_path):
    refresh(spark, sample, str(tmp_path / "out"))
    tables = refresh(spark, edges, str(tmp_path / "out"), overwrite=True)
    assert contents(tables) == contents(refresh(spark, edges, str(tmp_path / "fresh")))


def test_refresh_of_nothing(spark, sample, tmp_path):
    tables = refresh(spark, sample.limit(0), str(tmp_path / "out"))
    assert all(not found for found in contents(tables).values())
    publish_views(tables)
    assert spark.table("silver.sales_events").schema == S.SALES_EVENTS_SCHEMA
    assert spark.table("gold.features_daily").count() == 0


def test_refresh_stops_at_the_first_failure(spark, make_bronze, tmp_path):
    bad = make_bronze([{**SAMPLE_EVENTS[0], "qty": "x"}])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        refresh(spark, bad, str(tmp_path / "out"))
    assert not (tmp_path / "out" / "gold").exists()
    tables = refresh(spark, bad, str(tmp_path / "tolerant"), on_cast_error="quarantine")
    assert tables.sales_events.count() == 0
    assert tables.dim_store.count() == 1
    assert tables.cast_failures.count() == 1


def test_quarantine_covers_dates_of_any_kind(spark, make_bronze, tmp_path):
    good = SAMPLE_EVENTS[0]
    bad_date = {**good, "event_type": "return", "event_date": "someday", "store_id": "s9"}
    bronze = make_bronze([good, bad_date, {**good, "event_date": None, "event_type": "return"}])
    with pytest.raises(Exception, match="event_date is not a date"):
        refresh(spark, bronze, str(tmp_path / "strict"))
    tables = refresh(spark, bronze, str(tmp_path / "out"), on_cast_error="quarantine")
    assert tables.cast_failures.count() == 1
    assert {r[0] for r in rows(tables.dim_date)} == {date(2026, 3, 4), None}
    assert rows(tables.dim_date) == rows(O.dim_date(bronze, on_cast_error="quarantine"))
    assert rows(tables.dim_store) == [(good["store_id"],), ("s9",)]


def test_example_queries_through_the_catalog(spark, tmp_path):
    lines = spark.createDataFrame([(json.dumps(e),) for e in SAMPLE_EVENTS], "value string")
    bronze = str(tmp_path / "bronze")
    write_bronze(O.parse_lines(lines), bronze)
    tables = refresh(spark, O.bronze_events(O.parse_lines(lines)), str(tmp_path / "out"))
    model = predict_stockouts(tables)
    publish_views(tables, bronze, with_predictions=True)

    assert model.rows == 13
    sales = spark.sql("SELECT * FROM gold.fact_sales_daily ORDER BY date DESC LIMIT 10")
    assert sales.count() == 10
    risks = spark.sql(
        "SELECT * FROM gold.stockout_predictions ORDER BY pred_stockout_prob DESC LIMIT 10"
    )
    assert risks.count() == 10
    assert risks.first().pred_stockout_prob == max(
        r.pred_stockout_prob for r in tables.stockout_predictions.collect()
    )
    typed = spark.sql(
        "SELECT event:store_id::string AS store_id, sum(event:qty::decimal(38,0)) AS qty "
        "FROM bronze.raw_events WHERE event:event_type::string = 'sale' GROUP BY 1"
    )
    assert sum(int(r.qty) for r in typed.collect()) == 64
    assert spark.table("silver.inventory_events").count() == 8

    newer = refresh(spark, O.bronze_events(O.parse_lines(lines.limit(1))), str(tmp_path / "next"))
    publish_views(newer)
    assert spark.table("gold.fact_sales_daily").count() == 1


def test_prediction_table(spark, sample, tmp_path):
    tables = refresh(spark, sample, str(tmp_path / "out"))
    model = predict_stockouts(tables)
    expected = O.predictions(O.score(O.training_set(tables.features_daily), model))
    assert rows(tables.stockout_predictions) == rows(expected)
    assert tables.stockout_predictions.columns == S.PREDICTIONS_SCHEMA.fieldNames()


def test_keyed_predictions(spark, sample, tmp_path):
    tables = refresh(spark, sample, str(tmp_path / "out"))
    predict_stockouts(tables, keep_keys=True)
    keyed = tables.stockout_predictions_keyed
    assert rows(keyed.select(*S.PREDICTIONS_SCHEMA.fieldNames())) == rows(tables.stockout_predictions)
    assert keyed.select("date", "store_id", "product_id").distinct().count() == 13


def test_a_day_is_a_folder_with_one_file(spark, sample, tmp_path):
    refresh(spark, sample.repartition(8), str(tmp_path / "out"))
    for table in ("silver/events/event_type=sale", "gold/fact_sales_daily", "gold/features_daily"):
        days = sorted((tmp_path / "out" / table).glob("*date=*"))
        assert [d.name.split("=")[1] for d in days] == ["2026-03-04", "2026-03-05"]
        assert all(len(list(d.glob("*.parquet"))) == 1 for d in days)


def test_full_refresh_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    full_refresh(spark.range(5), path)
    full_refresh(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_shared_dir_is_in_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(f"{root}/x-") and first != second


def test_cluster_without_shared_folder_is_refused():
    from shelfwise import session

    class Context:
        master = "yarn"

    class Conf:
        @staticmethod
        def get(key, default):
            return default

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(RuntimeError):
        session.shared_dir(Session, "x")


def test_tune_starts_with_enough_partitions(spark):
    from shelfwise import tune

    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session = spark.newSession()
    assert tune(session).conf.get(key, None) is None
    assert tune(session, shuffle_partitions=64).conf.get(key) == "64"

"""Runs switched as a whole, and tables of declared types."""

from decimal import Decimal

import pytest

from shelfwise import predict_stockouts, refresh
from shelfwise import schema as S
from shelfwise.jobs import main
from shelfwise.plans import append_rows, current_run, declare_table, open_run, publish_run, replace_rows, save_bronze, save_predictions
from tests.conftest import rows
from tests.fixtures import SAMPLE_EVENTS


def test_a_reader_never_mixes_runs(spark, sample, make_bronze, tmp_path):
    """Runs are published between a reader's queries, and while it builds one."""
    runs = str(tmp_path / "runs")
    with pytest.raises(FileNotFoundError):
        current_run(spark, runs)
    first = refresh(spark, sample, str(tmp_path / "r0"))
    assert publish_run(first, runs) == 0
    reader = spark.newSession()
    open_run(reader, runs)
    half = reader.table("fact_sales_daily").alias("s")
    second = refresh(spark, make_bronze(SAMPLE_EVENTS[:3]), str(tmp_path / "r1"))
    assert publish_run(second, runs) == 1
    joined = half.join(reader.table("features_daily").alias("f"), ["date", "store_id", "product_id"])
    assert joined.count() == first.fact_sales_daily.count() == 13
    sql = "SELECT count(*) FROM fact_sales_daily JOIN features_daily USING (date, store_id, product_id) JOIN dim_store USING (store_id)"
    assert reader.sql(sql).first()[0] == 13
    assert open_run(reader, runs).root == second.root
    assert reader.sql(sql).first()[0] == second.fact_sales_daily.count() == 2
    assert rows(current_run(spark, runs).dim_date) == rows(second.dim_date)


def test_predictions_come_with_their_run(spark, sample, tmp_path):
    runs = str(tmp_path / "runs")
    tables = refresh(spark, sample, str(tmp_path / "r0"))
    predict_stockouts(tables)
    publish_run(tables, runs)
    reader = spark.newSession()
    open_run(reader, runs, prefix="now_")
    assert reader.table("now_stockout_predictions").schema == S.PREDICTIONS_SCHEMA
    assert not reader.catalog.tableExists("now_stockout_predictions_keyed")


@pytest.fixture
def namespace(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA declared LOCATION '{tmp_path}/declared'")
    yield "declared"
    spark.sql("DROP SCHEMA declared CASCADE")


def test_declared_predictions(spark, sample, make_bronze, tmp_path, namespace):
    tables = refresh(spark, sample, str(tmp_path / "r0"))
    predict_stockouts(tables)
    name = f"{namespace}.predictions"
    save_predictions(tables, name)
    save_predictions(tables, name)
    assert spark.table(name).schema == S.PREDICTIONS_SCHEMA
    assert rows(spark.table(name)) == rows(tables.stockout_predictions)
    best = spark.sql(f"SELECT * FROM {name} ORDER BY pred_stockout_prob DESC LIMIT 10")
    assert best.count() == 10


def test_declared_types_hold(spark, namespace):
    name = f"{namespace}.t"
    declare_table(spark, name, S.FACT_SALES_SCHEMA, partition_by=("date",))
    declare_table(spark, name, S.FACT_SALES_SCHEMA, partition_by=("date",))
    with pytest.raises(TypeError):
        declare_table(spark, name, S.FACT_INVENTORY_SCHEMA)
    row = "'p' AS product_id, 's' AS store_id, DATE'2026-01-02' AS date, 2 AS sales_event_count"
    append_rows(spark.sql(f"SELECT 7 AS total_qty_sold, {row}"), name)
    assert rows(spark.table(name).select("date", "store_id", "total_qty_sold"))[0][2] == 7
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|INCOMPATIBLE_DATA"):
        append_rows(spark.sql(f"SELECT 'many' AS total_qty_sold, {row}"), name)
    replace_rows(spark.sql(f"SELECT CAST(9 AS DECIMAL(5,0)) AS total_qty_sold, {row}"), name)
    assert [r.total_qty_sold for r in spark.table(name).collect()] == [Decimal(9)]


def test_declared_bronze(spark, make_bronze, namespace):
    name = f"{namespace}.raw_events"
    declare_table(spark, name, S.BRONZE_SCHEMA)
    assert spark.table(name).count() == 0
    save_bronze(spark, make_bronze(SAMPLE_EVENTS[:20]), name)
    save_bronze(spark, make_bronze(SAMPLE_EVENTS[20:]), name)
    kinds = spark.sql(f"SELECT event:event_type::string AS k, count(*) FROM {name} GROUP BY 1")
    assert {tuple(r) for r in kinds.collect()} == {("sale", 20), ("inventory", 8)}


def test_jobs_publish_runs_and_tables(spark, sample, tmp_path, namespace, capsys):
    sample.selectExpr("*", "CAST(NULL AS STRING) line", "CAST(NULL AS STRING) source_file", "'loaded' status").write.partitionBy("status").parquet(str(tmp_path / "bronze"))
    main(["refresh", "--bronze", str(tmp_path / "bronze"), "--out", str(tmp_path / "r"), "--runs", str(tmp_path / "runs")])
    assert "Run 0 is the current one" in capsys.readouterr().out
    assert current_run(spark, str(tmp_path / "runs")).features_daily.count() == 13
    main(["predict", "--tables", str(tmp_path / "r"), "--table", f"{namespace}.predictions"])
    assert spark.table(f"{namespace}.predictions").count() == 13

"""The shape of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from shelfwise import operators as O
from shelfwise import refresh
from shelfwise.plans.refresh import write_facts_and_features
from workload import derived as W
from workload import queries as Q

SF_DIR = "/root/testdata/sf0.01"


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return refresh(spark, W.bronze(spark, SF_DIR), str(tmp_path_factory.mktemp("plans") / "tables"))


@pytest.fixture
def no_broadcast(spark):
    """Nor pruning by the other side's days, which shows its plan a second time."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_features_shuffle_each_fact_once_and_the_join_nothing(tables, no_broadcast):
    features = O.features_daily(
        O.fact_sales_daily(tables.sales_events), O.fact_inventory_daily(tables.inventory_events)
    )
    plan = executed_plan(features)
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in plan


def above_kept_rows(plan):
    """The lines of a plan without those by which kept rows were computed."""
    lines, inside = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if inside is not None and depth > inside:
            continue
        inside = depth if "InMemoryRelation" in line else None
        lines.append(line)
    return "\n".join(lines)


def test_the_refresh_joins_kept_facts_without_an_exchange(spark, tables, no_broadcast):
    """Neither fact is shuffled for the features, and each is computed once for its own table and theirs."""
    plans, seen = {}, {}
    settings = ("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(key) for key in settings]

    def write(df, table):
        plans[table] = executed_plan(df)
        seen[table] = sorted(map(repr, df.collect()))

    write_facts_and_features(tables.sales_events, tables.inventory_events, 2, write)
    joined = plans["gold.features_daily"]
    assert joined.count("InMemoryRelation") == 2
    assert "SortMergeJoin" in above_kept_rows(joined) and "Exchange" not in above_kept_rows(joined)
    read_back = O.features_daily(tables.fact_sales_daily, tables.fact_inventory_daily)
    assert executed_plan(read_back).count("Exchange hashpartitioning") == 2
    assert seen["gold.features_daily"] == sorted(map(repr, read_back.collect()))
    assert [spark.conf.get(key) for key in settings] == before


def test_sales_combine_before_the_shuffle_without_sorting(tables):
    plan = executed_plan(O.fact_sales_daily(tables.sales_events))
    assert plan.count("HashAggregate") == 2
    assert "partial_" in plan
    assert "Sort" not in plan


def test_readings_are_cut_to_one_per_key_before_the_shuffle(tables):
    plan = executed_plan(O.fact_inventory_daily(tables.inventory_events))
    assert plan.count("Exchange hashpartitioning") == 1
    before = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_one_day_reads_its_own_files(tables):
    day = "date = DATE'2024-01-05'"
    for table in (tables.fact_sales_daily, tables.fact_inventory_daily, tables.features_daily):
        assert re.search(r"PartitionFilters: \[[^\]]*date[^\]]*2024-01-05", executed_plan(table.where(day)))
    events = tables.spark.read.parquet(tables.path("silver.events"))
    plan = executed_plan(events.where("event_date = DATE'2024-01-05'").select("qty"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date[^\]]*2024-01-05", plan)


def test_silver_kinds_are_partitions(tables):
    plan = executed_plan(tables.sales_events)
    assert re.search(r"PartitionFilters: \[[^\]]*event_type[^\]]*= sale", plan)
    assert "on_hand" not in plan.split("ReadSchema")[1]


def test_silver_reads_fields_not_documents(spark):
    plan = executed_plan(O.silver_sales(W.bronze(spark, SF_DIR)))
    schema = plan.split("ReadSchema")[1]
    assert "event:struct<" in schema
    assert re.search(r"PushedFilters: \[[^\]]*sale", plan)


def test_bronze_read_skips_the_rejects(spark):
    plan = executed_plan(W.bronze(spark, SF_DIR, W.raw_lines_with_broken))
    assert re.search(r"PartitionFilters: \[[^\]]*status[^\]]*= loaded", plan)


def test_all_dimensions_take_one_scan_and_one_shuffle(spark):
    plan = executed_plan(O.dimension_members(W.bronze(spark, SF_DIR)))
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1


def test_latest_per_key_limits_before_the_shuffle(spark):
    plan = executed_plan(Q.orders_latest_per_customer(spark, SF_DIR))
    before = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_top_k_sorts_nothing_whole(tables):
    plan = executed_plan(O.recent_sales(tables.fact_sales_daily))
    assert "TakeOrderedAndProject" in plan


def test_no_python_in_any_plan(spark):
    for name in ("features_daily", "stockout_score_fixed_model", "lineitem_features_daily", "publish_encode"):
        plan = executed_plan(Q.QUERIES[name](spark, SF_DIR))
        assert not re.search(r"Python|ArrowEval|MapInPandas", plan), name


def test_scoring_is_a_projection(tables):
    training = O.training_set(tables.features_daily)
    plan = executed_plan(O.score(training, Q.FIXED_MODEL))
    assert "Exchange" not in plan and "UDF" not in plan


def test_feature_filter_reaches_the_files(tables):
    plan = executed_plan(tables.fact_sales_daily.where(F.col("store_id") == "store_1").select("total_qty_sold"))
    assert "EqualTo(store_id,store_1)" in plan
    assert "sales_event_count" not in plan.split("ReadSchema")[1]

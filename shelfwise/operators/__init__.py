"""Batch operators on DataFrames, from Bronze to ranked predictions."""

from shelfwise.operators.bronze import bronze_events, load_counts, parse_lines, rejected_lines
from shelfwise.operators.dimensions import (
    dim_date,
    dim_product,
    dim_store,
    dimension_members,
    members_to_dim_date,
    members_to_dim_product,
    members_to_dim_store,
)
from shelfwise.operators.facts import fact_inventory_daily, fact_sales_daily
from shelfwise.operators.features import features_daily
from shelfwise.operators.ranking import (
    latest_per_key,
    recent_sales,
    riskiest,
    run_report,
    top_k,
)
from shelfwise.operators.silver import (
    cast_failures,
    silver_events,
    silver_inventory,
    silver_sales,
)
from shelfwise.operators.stockout import (
    StockoutModel,
    predictions,
    score,
    train_stockout,
    training_set,
)

__all__ = [
    "StockoutModel",
    "bronze_events",
    "cast_failures",
    "dim_date",
    "dim_product",
    "dim_store",
    "dimension_members",
    "fact_inventory_daily",
    "fact_sales_daily",
    "features_daily",
    "latest_per_key",
    "load_counts",
    "members_to_dim_date",
    "members_to_dim_product",
    "members_to_dim_store",
    "parse_lines",
    "predictions",
    "recent_sales",
    "rejected_lines",
    "riskiest",
    "run_report",
    "score",
    "silver_events",
    "silver_inventory",
    "silver_sales",
    "top_k",
    "train_stockout",
    "training_set",
]

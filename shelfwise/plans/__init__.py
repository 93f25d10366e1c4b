"""Whole jobs: the ordered full refresh, the update by touched days, the prediction job, catalog views."""

from shelfwise.plans.catalog import publish_predictions, publish_views
from shelfwise.plans.declared import append_rows, declare_table, replace_rows, save_bronze, save_predictions
from shelfwise.plans.refresh import Lakehouse, predict_stockouts, refresh
from shelfwise.plans.runs import current_run, open_run, publish_run
from shelfwise.plans.update import update

__all__ = [
    "Lakehouse",
    "append_rows",
    "current_run",
    "declare_table",
    "open_run",
    "predict_stockouts",
    "publish_predictions",
    "publish_run",
    "publish_views",
    "refresh",
    "replace_rows",
    "save_bronze",
    "save_predictions",
    "update",
]

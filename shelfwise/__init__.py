"""Retail events on Spark: raw JSON to typed tables, daily facts and stock-out risk."""

from importlib import import_module

_HOMES = {
    "Lakehouse": "shelfwise.plans",
    "predict_stockouts": "shelfwise.plans",
    "publish_predictions": "shelfwise.plans",
    "publish_views": "shelfwise.plans",
    "refresh": "shelfwise.plans",
    "shared_dir": "shelfwise.session",
    "tune": "shelfwise.session",
    "update": "shelfwise.plans",
}
__all__ = list(_HOMES)


def __getattr__(name: str):
    """Names are fetched when they are used: a task that imports one module pays for no other."""
    if name not in _HOMES:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    return getattr(import_module(_HOMES[name]), name)

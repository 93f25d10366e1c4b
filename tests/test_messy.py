"""Whole refreshes of random messy events against a plain Python model."""

import json
import random
from datetime import date, datetime

import pytest

from shelfwise import refresh
from tests.conftest import rows

MISSING = object()
BAD = object()

# Value as it stands in the JSON -> value after the cast.
KINDS = [("sale", "sale")] * 4 + [("inventory", "inventory")] * 3 + [("return", "return"), (None, None), (MISSING, None)]
DATES = [("2026-02-21", date(2026, 2, 21))] * 3 + [
    ("2026-02-22", date(2026, 2, 22)),
    (None, None),
    (MISSING, None),
    ("2026-02-30", BAD),
    (20260221, BAD),
]
TIMES = [(f"2026-02-21T10:00:0{s}.{u:06d}+00:00", datetime(2026, 2, 21, 10, 0, s, u)) for s in (0, 9) for u in (0, 5)]
TIMES += [(None, None), (MISSING, None), ("noon", BAD)]
NAMES = [("a", "a"), ("a", "a"), ("b", "b"), (7, "7"), (None, None), (MISSING, None)]
NUMBERS = [(1, 1), (2, 2), ("3", 3), (2.5, 3), (40, 40), (None, None), (MISSING, None), ("x", BAD), ([1], BAD)]

POOLS = {
    "event_type": KINDS,
    "event_time": TIMES,
    "event_date": DATES,
    "store_id": NAMES,
    "product_id": NAMES,
    "qty": NUMBERS,
    "on_hand": NUMBERS,
}


def messy_events(seed, size):
    """Pairs of the event as written and its cast fields."""
    rng = random.Random(seed)
    for _ in range(size):
        chosen = {name: rng.choice(pool) for name, pool in POOLS.items()}
        written = {name: raw for name, (raw, _) in chosen.items() if raw is not MISSING}
        yield written, {name: value for name, (_, value) in chosen.items()}


def expected_tables(events):
    needed = {"sale": ("event_time", "event_date", "qty"), "inventory": ("event_time", "event_date", "on_hand")}
    dates, stores, products, failures = set(), set(), set(), 0
    sales, latest = {}, {}
    for written, cast in events:
        failed = any(cast[name] is BAD for name in needed.get(cast["event_type"], ("event_date",)))
        failures += failed
        if "event_date" in written and cast["event_date"] is not BAD:
            dates.add(cast["event_date"])
        if "store_id" in written:
            stores.add((cast["store_id"],))
        if "product_id" in written:
            products.add((cast["product_id"],))
        key = (cast["event_date"], cast["store_id"], cast["product_id"])
        if failed:
            continue
        if cast["event_type"] == "sale":
            total, count = sales.get(key, (None, 0))
            if cast["qty"] is not None:
                total = (total or 0) + cast["qty"]
            sales[key] = (total, count + 1)
        elif cast["event_type"] == "inventory":
            time, stock = cast["event_time"], cast["on_hand"]
            order = (time is None, time or datetime.min, stock is not None, -(stock or 0))
            if key not in latest or order > latest[key][0]:
                latest[key] = (order, stock, time)
    features = []
    for key, (total, count) in sales.items():
        stock = latest[key][1] if key in latest and None not in key else None
        features.append((*key, total, count, stock, int(stock is not None and stock <= 2)))
    return {
        "dates": dates,
        "stores": sorted(stores, key=repr),
        "products": sorted(products, key=repr),
        "sales": sorted(((*k, *v) for k, v in sales.items()), key=repr),
        "inventory": sorted(((*k, s, t) for k, (_, s, t) in latest.items()), key=repr),
        "features": sorted(features, key=repr),
        "failures": failures,
    }


@pytest.mark.parametrize("is_stored", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_refresh_of_messy_events(spark, make_bronze, stored, tmp_path, seed, is_stored):
    events = list(messy_events(seed, 600))
    bronze = make_bronze([json.dumps(written) for written, _ in events])
    bronze = stored(bronze, "bronze") if is_stored else bronze.repartition(5)
    tables = refresh(spark, bronze, str(tmp_path / "out"), on_cast_error="quarantine")
    got = {
        "dates": {r.date for r in tables.dim_date.collect()},
        "stores": rows(tables.dim_store),
        "products": rows(tables.dim_product),
        "sales": rows(tables.fact_sales_daily),
        "inventory": rows(tables.fact_inventory_daily),
        "features": rows(tables.features_daily),
        "failures": tables.cast_failures.count(),
    }
    assert got == expected_tables(events)


@pytest.mark.parametrize("is_stored", [False, True])
def test_strict_refresh_of_clean_events(spark, make_bronze, stored, tmp_path, is_stored):
    """Without bad values the strict refresh equals the model, too."""
    events = [e for e in messy_events(9, 900) if BAD not in e[1].values()]
    bronze = make_bronze([json.dumps(written) for written, _ in events])
    bronze = stored(bronze, "bronze") if is_stored else bronze
    tables = refresh(spark, bronze, str(tmp_path / "out"))
    expected = expected_tables(events)
    assert rows(tables.features_daily) == expected["features"]
    assert rows(tables.fact_inventory_daily) == expected["inventory"]
    assert rows(tables.dim_store) == expected["stores"]

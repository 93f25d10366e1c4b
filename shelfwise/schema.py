"""Event fields, table schemas and the fixed parameters of the lakehouse."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
SALE = "sale"
INVENTORY = "inventory"
LOW_STOCK_THRESHOLD = 2
REPORT_SIZE = 10
FLUSH_EVENTS = 5000
FLUSH_INTERVAL = "1h"
DEFAULT_TOPIC = "retail_events"
MAX_LOAD_BYTES = 1 << 40
# Files of one load from the table of names: as many paths as the driver holds.
MAX_LOAD_FILES = 50_000

# Raw files: those named so by other producers, and those of the landing job, but for the
# messages that it set aside.
RAW_FILE_GLOB = "{*.jsonl,part-*.txt}"
RAW_PATH_REGEX = "^(?!.*/state=(quarantined|undated)/)"

# Bounds on one batch of the topic, and on the part of it that one task reads.
MAX_BATCH_EVENTS = 10_000_000
MAX_TASK_EVENTS = 500_000
# How long the stream of raw files remembers a file; it passes over files older than that
# against the newest. The default of a week would pass over a backfilled file that kept its time.
REMEMBER_FILES = "36500d"

NUMBER = "decimal(38,0)"

# JSON field -> type it is cast to.
EVENT_FIELDS = {
    "event_type": "string",
    "event_time": "timestamp_ntz",
    "event_date": "date",
    "store_id": "string",
    "product_id": "string",
    "qty": NUMBER,
    "on_hand": NUMBER,
}

# The fields each kind of event carries besides its kind.
SALE_FIELDS = ("event_time", "event_date", "store_id", "product_id", "qty")
INVENTORY_FIELDS = ("event_time", "event_date", "store_id", "product_id", "on_hand")

DAILY_KEYS = ("date", "store_id", "product_id")
FEATURE_COLUMNS = ("total_qty_sold", "sales_event_count", "on_hand_latest")
LABEL_COLUMN = "stockout_risk_label"
PROBABILITY_COLUMN = "pred_stockout_prob"


_TEXT = T.StringType()
_DATE = T.DateType()
_TIME = T.TimestampNTZType()
_NUMBER = T.DecimalType(38, 0)
_INT = T.IntegerType()
_LONG = T.LongType()
_VARIANT = T.VariantType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


BRONZE_SCHEMA = _struct(ingested_at=_TIME, event=_VARIANT)
BRONZE_LOG_SCHEMA = _struct(
    ingested_at=_TIME, event=_VARIANT, line=_TEXT, source_file=_TEXT, status=_TEXT
)
SILVER_EVENTS_SCHEMA = _struct(
    event_time=_TIME,
    event_date=_DATE,
    store_id=_TEXT,
    product_id=_TEXT,
    qty=_NUMBER,
    on_hand=_NUMBER,
    event_type=_TEXT,
)
SALES_EVENTS_SCHEMA = _struct(
    event_time=_TIME, event_date=_DATE, store_id=_TEXT, product_id=_TEXT, qty=_NUMBER
)
INVENTORY_EVENTS_SCHEMA = _struct(
    event_time=_TIME, event_date=_DATE, store_id=_TEXT, product_id=_TEXT, on_hand=_NUMBER
)
DIM_DATE_SCHEMA = _struct(date=_DATE, year=_INT, month=_INT, day=_INT, day_of_week=_INT)
DIM_STORE_SCHEMA = _struct(store_id=_TEXT)
DIM_PRODUCT_SCHEMA = _struct(product_id=_TEXT)
DIMENSION_MEMBERS_SCHEMA = _struct(
    member_of=_INT, date=_DATE, store_id=_TEXT, product_id=_TEXT
)
FACT_SALES_SCHEMA = _struct(
    date=_DATE, store_id=_TEXT, product_id=_TEXT, total_qty_sold=_NUMBER, sales_event_count=_LONG
)
FACT_INVENTORY_SCHEMA = _struct(
    date=_DATE, store_id=_TEXT, product_id=_TEXT, on_hand_latest=_NUMBER, last_inventory_time=_TIME
)
FEATURES_SCHEMA = _struct(
    date=_DATE,
    store_id=_TEXT,
    product_id=_TEXT,
    total_qty_sold=_NUMBER,
    sales_event_count=_LONG,
    on_hand_latest=_NUMBER,
    stockout_risk_label=_INT,
)
PREDICTIONS_SCHEMA = _struct(
    total_qty_sold=_NUMBER,
    sales_event_count=_NUMBER,
    on_hand_latest=_NUMBER,
    stockout_risk_label=_NUMBER,
    pred_stockout_prob=T.DoubleType(),
)
KEYED_PREDICTIONS_SCHEMA = _struct(
    date=_DATE, store_id=_TEXT, product_id=_TEXT, **{f.name: f.dataType for f in PREDICTIONS_SCHEMA.fields}
)

"""The same results in plain SQL over the given tables."""

from __future__ import annotations

from workload.derived import BROKEN_KIND, PRODUCTS, READABLE_QTY
from workload.queries import FIXED_MODEL, SCORED_DECIMALS, TRAINED_DECIMALS

_PRODUCT_LIST = ", ".join(f"'{name}'" for name in PRODUCTS)

# Newton steps of the trained-model check; it settles in fewer.
_NEWTON_STEPS = 14

_RAW = f"""
numbered AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
raw AS (
    SELECT
        event_id,
        CASE n.event_type WHEN 'purchase' THEN 'sale' WHEN 'view' THEN 'inventory'
            ELSE n.event_type END AS kind,
        ts AS event_time,
        CAST(ts AS DATE) AS event_date,
        'store_' || CAST(user_id % 3 + 1 AS VARCHAR) AS store_id,
        list_extract([{_PRODUCT_LIST}], event_id % 5 + 1) AS product_id,
        CASE WHEN n.event_type = 'purchase' THEN k % 4 + 1 END AS qty,
        CASE WHEN n.event_type = 'view' THEN k % 21 END AS on_hand
    FROM numbered n
)"""

_TEXT = """
text AS (
    SELECT
        *,
        '{"event_type":"' || kind
        || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
        || '","event_date":"' || strftime(event_date, '%Y-%m-%d')
        || '","store_id":"' || store_id
        || '","product_id":"' || product_id || '"'
        || coalesce(',"qty":' || CAST(qty AS VARCHAR), '')
        || coalesce(',"on_hand":' || CAST(on_hand AS VARCHAR), '')
        || '}' AS line
    FROM raw
)"""

_FACTS = """
sales_fact AS (
    SELECT event_date AS date, store_id, product_id,
        CAST(sum(qty) AS BIGINT) AS total_qty_sold, count(*) AS sales_event_count
    FROM raw WHERE kind = 'sale' GROUP BY 1, 2, 3
),
inventory_fact AS (
    SELECT event_date AS date, store_id, product_id,
        on_hand AS on_hand_latest, event_time AS last_inventory_time
    FROM raw WHERE kind = 'inventory'
    QUALIFY row_number() OVER (
        PARTITION BY event_date, store_id, product_id
        ORDER BY event_time DESC NULLS FIRST, on_hand ASC NULLS LAST) = 1
)"""

_FEATURES = """
features AS (
    SELECT s.date, s.store_id, s.product_id, s.total_qty_sold, s.sales_event_count,
        i.on_hand_latest,
        CASE WHEN i.on_hand_latest <= 2 THEN 1 ELSE 0 END AS stockout_risk_label
    FROM sales_fact s LEFT JOIN inventory_fact i
        ON s.date = i.date AND s.store_id = i.store_id AND s.product_id = i.product_id
)"""

_TRAINING = """
training AS (
    SELECT date, store_id, product_id, total_qty_sold, sales_event_count,
        coalesce(on_hand_latest, 0) AS on_hand_latest,
        CAST(stockout_risk_label AS BIGINT) AS stockout_risk_label
    FROM features WHERE stockout_risk_label IS NOT NULL
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


_FROM_RAW = _with(_RAW)
_FROM_TEXT = _with(_RAW, _TEXT)
_FROM_FACTS = _with(_RAW, _FACTS)
_FROM_FEATURES = _with(_RAW, _FACTS, _FEATURES)
_FROM_TRAINING = _with(_RAW, _FACTS, _FEATURES, _TRAINING)


def _newton_steps() -> str:
    """Trained weights by Newton's method, one step after another.

    Each step sums the gradient and the curvature over the training rows and
    solves the four equations by elimination on the symmetric matrix.
    """
    steps = [
        """
points AS MATERIALIZED (
    SELECT CAST(total_qty_sold AS DOUBLE) AS x1, CAST(sales_event_count AS DOUBLE) AS x2,
        CAST(on_hand_latest AS DOUBLE) AS x3, CAST(stockout_risk_label AS DOUBLE) AS y,
        CAST(count(*) AS DOUBLE) AS n
    FROM training GROUP BY 1, 2, 3, 4
),
weights0 AS MATERIALIZED (
    SELECT CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1,
        CAST(0 AS DOUBLE) AS b2, CAST(0 AS DOUBLE) AS b3
)"""
    ]
    for step in range(1, _NEWTON_STEPS + 1):
        steps.append(f"""
curved{step} AS MATERIALIZED (
    SELECT
        sum(n * (p - y)) AS g0, sum(n * (p - y) * x1) + any_value(b1) AS g1,
        sum(n * (p - y) * x2) + any_value(b2) AS g2, sum(n * (p - y) * x3) + any_value(b3) AS g3,
        sum(v) AS a00, sum(v * x1) AS a01, sum(v * x2) AS a02, sum(v * x3) AS a03,
        sum(v * x1 * x1) + 1 AS a11, sum(v * x1 * x2) AS a12, sum(v * x1 * x3) AS a13,
        sum(v * x2 * x2) + 1 AS a22, sum(v * x2 * x3) AS a23, sum(v * x3 * x3) + 1 AS a33,
        any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, any_value(b3) AS b3
    FROM (
        SELECT *, n * p * (1 - p) AS v FROM (
            SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2 + b3 * x3))) AS p
            FROM points, weights{step - 1}
        )
    )
),
reduced1_{step} AS (
    SELECT *, a01 / a00 AS l10, a02 / a00 AS l20, a03 / a00 AS l30 FROM curved{step}
),
reduced2_{step} AS (
    SELECT *, a11 - l10 * a01 AS d1, a12 - l10 * a02 AS r12, a13 - l10 * a03 AS r13,
        a22 - l20 * a02 AS r22, a23 - l20 * a03 AS r23, a33 - l30 * a03 AS r33,
        g1 - l10 * g0 AS z1
    FROM reduced1_{step}
),
reduced3_{step} AS (
    SELECT *, r12 / d1 AS l21, r13 / d1 AS l31, r22 - r12 * r12 / d1 AS d2,
        r23 - r12 * r13 / d1 AS s23, r33 - r13 * r13 / d1 AS s33
    FROM reduced2_{step}
),
reduced4_{step} AS (
    SELECT *, s23 / d2 AS l32, s33 - s23 * s23 / d2 AS d3, g2 - l20 * g0 - l21 * z1 AS z2
    FROM reduced3_{step}
),
solved3_{step} AS (
    SELECT *, (g3 - l30 * g0 - l31 * z1 - l32 * z2) / d3 AS u3 FROM reduced4_{step}
),
solved2_{step} AS (SELECT *, z2 / d2 - l32 * u3 AS u2 FROM solved3_{step}),
solved1_{step} AS (SELECT *, z1 / d1 - l21 * u2 - l31 * u3 AS u1 FROM solved2_{step}),
solved0_{step} AS (
    SELECT *, g0 / a00 - l10 * u1 - l20 * u2 - l30 * u3 AS u0 FROM solved1_{step}
),
weights{step} AS MATERIALIZED (
    SELECT b0 - u0 AS b0, b1 - u1 AS b1, b2 - u2 AS b2, b3 - u3 AS b3 FROM solved0_{step}
)""")
    return ",".join(steps)


_FROM_TRAINED = _with(_RAW, _FACTS, _FEATURES, _TRAINING, _newton_steps())

_TYPED = "kind AS event_type, event_time, event_date, store_id, product_id, qty, on_hand"
_INPUTS = "total_qty_sold, sales_event_count, on_hand_latest, stockout_risk_label"
_KEYS = "date, store_id, product_id"
_LOGIT = "b0 + b1 * total_qty_sold + b2 * sales_event_count + b3 * on_hand_latest"


def _fixed_probability() -> str:
    b1, b2, b3 = FIXED_MODEL.coefficients
    logit = (
        f"{FIXED_MODEL.intercept}::DOUBLE + {b1}::DOUBLE * total_qty_sold "
        f"+ {b2}::DOUBLE * sales_event_count + {b3}::DOUBLE * on_hand_latest"
    )
    return f"1 / (1 + exp(-({logit})))"


def _scored(columns: str, probability: str, decimals: int) -> str:
    return f"SELECT {columns}, round({probability}, {decimals}) AS pred_stockout_prob FROM training"


def _trained(columns: str) -> str:
    probability = f"1 / (1 + exp(-({_LOGIT})))"
    return (
        _FROM_TRAINED
        + _scored(columns, probability, TRAINED_DECIMALS)
        + f", weights{_NEWTON_STEPS}"
    )


_RANKED_BY_FIXED = f"""
SELECT {_INPUTS}, round(p, {SCORED_DECIMALS}) AS pred_stockout_prob
FROM (SELECT *, {_fixed_probability()} AS p FROM training)
ORDER BY p DESC, total_qty_sold, sales_event_count, on_hand_latest, stockout_risk_label
LIMIT 10
"""

_PATH_DAY = "strftime(event_date, '%Y') AS y, strftime(event_date, '%m') AS m, strftime(event_date, '%d') AS d"
_CUT_LINE = "rtrim(line, '}')"
_FEATURE_COLUMNS = f"{_KEYS}, total_qty_sold, sales_event_count, on_hand_latest, stockout_risk_label"


def _lineitem_sales(store: str, product: str) -> str:
    return f"""
    SELECT CAST(l_shipdate AS DATE) AS date, CAST({store} AS VARCHAR) AS store_id,
        CAST({product} AS VARCHAR) AS product_id,
        CAST(sum(CAST(l_quantity AS DECIMAL(38,0))) AS BIGINT) AS total_qty_sold,
        count(*) AS sales_event_count
    FROM lineitem GROUP BY 1, 2, 3"""


def _lineitem_inventory(store: str, product: str) -> str:
    return f"""
    SELECT CAST(l_shipdate AS DATE) AS date, CAST({store} AS VARCHAR) AS store_id,
        CAST({product} AS VARCHAR) AS product_id,
        CAST(l_quantity AS BIGINT) AS on_hand_latest, l_shipdate AS last_inventory_time
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY CAST(l_shipdate AS DATE), {store}, {product}
        ORDER BY l_shipdate DESC NULLS FIRST, l_quantity ASC NULLS LAST) = 1"""


# The untidy events: fields as JSON text, NULL where a field is missing.
_UNTIDY = f"""
untidy AS (
    SELECT *,
        CASE WHEN kind = 'inventory' THEN
            CASE event_id % 11 WHEN 0 THEN 'null' WHEN 1 THEN NULL
                ELSE strftime(event_time, '"%Y-%m-%dT%H:00:00+00:00"') END
        ELSE
            CASE event_id % 11 WHEN 0 THEN strftime(event_time, '"%Y-%m-%dT%H:%M:%S.%f+05:30"')
                WHEN 1 THEN 'null' ELSE strftime(event_time, '"%Y-%m-%dT%H:%M:%S.%f+00:00"') END
        END AS time_json,
        CASE event_id % 13 WHEN 0 THEN 'null' WHEN 1 THEN NULL WHEN 2 THEN '""'
            ELSE strftime(event_date, '"%Y-%m-%d"') END AS date_json,
        CASE event_id % 7 WHEN 0 THEN 'null' WHEN 1 THEN NULL ELSE '"' || store_id || '"' END AS store_json,
        CASE event_id % 17 WHEN 0 THEN NULL WHEN 1 THEN 'null' ELSE '"' || product_id || '"' END AS product_json,
        CASE WHEN kind = 'sale' THEN
            CASE event_id % 5 WHEN 0 THEN '"' || qty || '"' WHEN 1 THEN qty || '.5' WHEN 2 THEN 'null'
                ELSE qty::VARCHAR END END AS qty_json,
        CASE WHEN kind = 'inventory' THEN
            CASE event_id % 19 WHEN 0 THEN '"' || on_hand || '"' WHEN 1 THEN 'null' WHEN 2 THEN NULL
                ELSE on_hand::VARCHAR END END AS on_hand_json
    FROM raw
),
untidy_typed AS (
    SELECT kind, date_json, store_json, product_json,
        CASE WHEN time_json <> 'null' THEN strptime(substr(time_json, 2, 19), '%Y-%m-%dT%H:%M:%S')
            + to_microseconds(coalesce(try_cast(rpad(regexp_extract(time_json, '[.]([0-9]+)', 1), 6, '0') AS BIGINT), 0)) END AS event_time,
        CASE WHEN date_json NOT IN ('null', '""') THEN event_date END AS event_date,
        CASE WHEN store_json <> 'null' THEN store_id END AS store_id,
        CASE WHEN product_json <> 'null' THEN product_id END AS product_id,
        CASE WHEN qty_json <> 'null' THEN CASE event_id % 5 WHEN 1 THEN qty + 1 ELSE qty END END AS qty,
        CASE WHEN on_hand_json <> 'null' THEN on_hand END AS on_hand
    FROM untidy
),
untidy_text AS (
    SELECT '{{' || concat_ws(',', '"event_type":"' || kind || '"', '"event_time":' || time_json,
        '"event_date":' || date_json, '"store_id":' || store_json, '"product_id":' || product_json,
        '"qty":' || qty_json, '"on_hand":' || on_hand_json) || '}}' AS line,
        date_json IS NOT NULL AND date_json NOT IN ('null', '""') AS dated
    FROM untidy
)"""

# The ways of spoiling a line, by the rest of the event's number by eight.
_SPOILT = """
spoilt AS (
    SELECT event_id % 8 AS way, event_date,
        CASE event_id % 8 WHEN 0 THEN line WHEN 1 THEN rtrim(line, '}') WHEN 2 THEN line[1:25]
            WHEN 3 THEN line || '}' WHEN 4 THEN '[1,' || line || ']' WHEN 5 THEN event_id::VARCHAR
            WHEN 6 THEN line || line ELSE 'x' || line END AS line
    FROM text
)"""
_FROM_UNTIDY = _with(_RAW, _UNTIDY)
_FROM_SPOILT = _with(_RAW, _TEXT, _SPOILT)


ORACLE_SQL: dict[str, str] = {
    # A list and a number are JSON documents, so Bronze loads them.
    "untidy_rejected_lines": _FROM_SPOILT + "SELECT line FROM spoilt WHERE way NOT IN (0, 4, 5)",
    "untidy_landing": _with(_RAW, _TEXT, _SPOILT, _UNTIDY)
    + """SELECT 'landed' AS state, line, dated AS under_own_date FROM untidy_text
    UNION ALL SELECT CASE way WHEN 0 THEN 'landed' ELSE 'quarantined' END, line, way = 0 FROM spoilt""",
    "landing_undated": _FROM_TEXT
    + """SELECT regexp_replace(line, '"event_date":"[^"]*"', '"event_date":"someday"') AS line
    FROM text WHERE event_id % 3 = 0""",
    "untidy_silver_sales": _FROM_UNTIDY
    + "SELECT event_time, event_date, store_id, product_id, qty FROM untidy_typed WHERE kind = 'sale'",
    "untidy_dimension_members": _FROM_UNTIDY
    + """SELECT DISTINCT 3 AS member_of, event_date AS date, CAST(NULL AS VARCHAR) AS store_id,
        CAST(NULL AS VARCHAR) AS product_id FROM untidy_typed WHERE date_json <> '""'
    UNION ALL SELECT DISTINCT 5, NULL, store_id, NULL FROM untidy_typed WHERE store_json IS NOT NULL
    UNION ALL SELECT DISTINCT 6, NULL, NULL, product_id FROM untidy_typed WHERE product_json IS NOT NULL""",
    "untidy_dim_store": _FROM_UNTIDY + "SELECT DISTINCT store_id FROM untidy_typed WHERE store_json IS NOT NULL",
    "untidy_fact_inventory": _FROM_UNTIDY
    + """SELECT event_date AS date, store_id, product_id, on_hand AS on_hand_latest,
        event_time AS last_inventory_time FROM untidy_typed WHERE kind = 'inventory'
    QUALIFY row_number() OVER (PARTITION BY event_date, store_id, product_id
        ORDER BY event_time DESC NULLS FIRST, on_hand ASC NULLS LAST) = 1""",
    "bronze_ingested_at": "SELECT count(*) AS events, true AS in_time FROM events",
    "publish_encode": _FROM_TEXT + "SELECT line AS message FROM text",
    "publish_encode_roundtrip": _FROM_RAW + f"SELECT {_TYPED} FROM raw",
    "raw_file_scan": _FROM_TEXT + "SELECT line FROM text",
    "raw_landing_partitions": _FROM_RAW
    + f"SELECT {_PATH_DAY}, count(*) AS line_count FROM raw GROUP BY 1, 2, 3",
    "raw_landing_lines": _FROM_TEXT
    + f"SELECT {_PATH_DAY}, line FROM text WHERE kind <> '{BROKEN_KIND}'",
    "raw_landing_quarantine": _FROM_TEXT
    + f"SELECT {_CUT_LINE} AS line FROM text WHERE kind = '{BROKEN_KIND}'",
    "bronze_events_typed": _FROM_RAW + f"SELECT {_TYPED} FROM raw",
    "bronze_parse_lines": _FROM_RAW + f"SELECT {_TYPED} FROM raw",
    "bronze_load_skip_malformed": _FROM_RAW
    + f"SELECT {_TYPED} FROM raw WHERE kind <> '{BROKEN_KIND}'",
    "bronze_rejected_lines": _FROM_TEXT
    + f"SELECT {_CUT_LINE} AS line FROM text WHERE kind = '{BROKEN_KIND}'",
    "bronze_incremental_stream": _FROM_RAW
    + f"SELECT {_TYPED} FROM raw WHERE kind <> '{BROKEN_KIND}'",
    "bronze_incremental_rejects": _FROM_TEXT
    + f"SELECT {_CUT_LINE} AS line, CAST(day(event_date) AS INTEGER) AS day "
    + f"FROM text WHERE kind = '{BROKEN_KIND}'",
    "silver_sales_events": _FROM_RAW
    + "SELECT event_time, event_date, store_id, product_id, qty FROM raw WHERE kind = 'sale'",
    "silver_inventory_events": _FROM_RAW
    + "SELECT event_time, event_date, store_id, product_id, on_hand "
    + "FROM raw WHERE kind = 'inventory'",
    "silver_events_one_pass": _FROM_RAW
    + f"SELECT {_TYPED} FROM raw WHERE kind IN ('sale', 'inventory')",
    "silver_sales_quarantined": _FROM_RAW
    + "SELECT event_time, event_date, store_id, product_id, qty "
    + f"FROM raw WHERE kind = 'sale' AND qty <= {READABLE_QTY}",
    "silver_cast_failures": _FROM_RAW
    + "SELECT event_time, store_id, product_id, 'many' AS qty_text, CAST(NULL AS BIGINT) AS qty "
    + f"FROM raw WHERE kind = 'sale' AND qty > {READABLE_QTY}",
    "dim_date": _FROM_RAW
    + """SELECT DISTINCT event_date AS date, CAST(year(event_date) AS INTEGER) AS year,
        CAST(month(event_date) AS INTEGER) AS month, CAST(day(event_date) AS INTEGER) AS day,
        CAST(dayofweek(event_date) AS INTEGER) AS day_of_week FROM raw""",
    "dim_store": _FROM_RAW + "SELECT DISTINCT store_id FROM raw",
    "dim_product": _FROM_RAW + "SELECT DISTINCT product_id FROM raw",
    "dimension_members": _FROM_RAW
    + """SELECT CAST(grouping(event_date, store_id, product_id) AS INTEGER) AS member_of,
        event_date AS date, store_id, product_id
    FROM raw GROUP BY GROUPING SETS ((event_date), (store_id), (product_id))""",
    "fact_sales_daily": _FROM_FACTS + "SELECT * FROM sales_fact",
    "fact_inventory_daily": _FROM_FACTS + "SELECT * FROM inventory_fact",
    "features_daily": _FROM_FEATURES + "SELECT * FROM features",
    "recent_sales_top10": _FROM_FACTS
    + "SELECT * FROM sales_fact ORDER BY date DESC NULLS FIRST, store_id, product_id LIMIT 10",
    "training_set": _FROM_TRAINING + f"SELECT {_INPUTS} FROM training",
    "training_set_with_inventory": _FROM_FEATURES
    + f"""SELECT {_KEYS}, total_qty_sold, sales_event_count, on_hand_latest,
        CAST(stockout_risk_label AS BIGINT) AS stockout_risk_label
    FROM features WHERE on_hand_latest IS NOT NULL""",
    "stockout_score_fixed_model": _FROM_TRAINING
    + _scored(f"{_KEYS}, {_INPUTS}", _fixed_probability(), SCORED_DECIMALS),
    "riskiest_top10": _FROM_TRAINING + _RANKED_BY_FIXED,
    "run_report_top10": _FROM_TRAINING
    + f"SELECT *, (SELECT count(*) FROM training) AS rows_used FROM ({_RANKED_BY_FIXED})",
    "stockout_model": _FROM_TRAINED
    + f"""SELECT (SELECT count(*) FROM training) AS row_count,
        round(b1, {TRAINED_DECIMALS}) AS total_qty_sold,
        round(b2, {TRAINED_DECIMALS}) AS sales_event_count,
        round(b3, {TRAINED_DECIMALS}) AS on_hand_latest,
        round(b0, {TRAINED_DECIMALS}) AS intercept
    FROM weights{_NEWTON_STEPS}""",
    "stockout_predictions": _trained(_INPUTS),
    "stockout_predictions_keyed": _trained(f"{_KEYS}, {_INPUTS}"),
    "refresh_features_daily": _FROM_FEATURES + "SELECT * FROM features",
    "refresh_predictions": _trained(_INPUTS),
    "lineitem_sales_daily": _lineitem_sales("l_suppkey", "l_partkey"),
    "lineitem_inventory_daily": _lineitem_inventory("l_suppkey", "l_linenumber"),
    "lineitem_features_daily": f"""
    WITH sales_fact AS ({_lineitem_sales("l_linestatus", "l_linenumber")}),
    inventory_fact AS ({_lineitem_inventory("l_linestatus", "l_linenumber")}),
    {_FEATURES}
    SELECT {_FEATURE_COLUMNS} FROM features""",
    "lineitem_message_text": """
    SELECT '{"event_time":"' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
        || '","event_date":"' || strftime(l_shipdate, '%Y-%m-%d')
        || '","store_id":"' || CAST(l_suppkey AS VARCHAR)
        || '","product_id":"' || CAST(l_partkey AS VARCHAR)
        || '","qty":' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '}' AS message
    FROM lineitem""",
    "orders_latest_per_customer": """
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders
    QUALIFY row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) = 1""",
}

# Tables brought up to date by and by hold what the same events hold at once.
ORACLE_SQL |= {
    "update_features_daily": ORACLE_SQL["refresh_features_daily"],
    "update_untidy_inventory": ORACLE_SQL["untidy_fact_inventory"],
    "update_untidy_dim_store": ORACLE_SQL["untidy_dim_store"],
    "bronze_file_load": ORACLE_SQL["bronze_incremental_stream"],
    "bronze_file_load_rejects": ORACLE_SQL["bronze_incremental_rejects"],
    "bronze_table": ORACLE_SQL["bronze_events_typed"],
    "predictions_table": ORACLE_SQL["refresh_predictions"],
    "refresh_current_run": _FROM_FEATURES
    + f"SELECT date, dayofweek(date)::INTEGER AS day_of_week, {_FEATURE_COLUMNS.removeprefix('date,')} FROM features",
}

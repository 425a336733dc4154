"""The same queries as plain SQL over the test tables, for the independent check."""

from __future__ import annotations

from tillroll.schemas import HIERARCHY_COLUMNS, MASTER_COLUMNS, TOP_PRODUCT_LABELS

_RAW_COLUMNS = (
    "event_id, event_time, event_type, product_id, category_id, category_code, brand, price, "
    "user_id, user_session"
)
_MASTER = ", ".join(MASTER_COLUMNS)

_ACTIVITY_RAW = """
activity_raw AS (
  SELECT event_id, date_trunc('hour', ts) AS event_time, event_type,
    k % 20 AS product_id, k % 6 + 100 AS category_id,
    CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'a' WHEN 2 THEN 'a.b' WHEN 3 THEN 'a.b.c'
      WHEN 4 THEN 'a.b.c.d' ELSE 'a.b.c.d.e' END AS category_code,
    CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'north' WHEN 2 THEN 'east' ELSE 'south' END AS brand,
    CASE WHEN value >= 1 THEN value END AS price,
    user_id,
    CASE WHEN user_id % 25 <> 0 THEN CAST(user_id % 30 AS VARCHAR) END AS user_session
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) numbered
)"""

_COMPLETE = (
    "event_time IS NOT NULL AND event_type IS NOT NULL AND product_id IS NOT NULL "
    "AND user_id IS NOT NULL AND user_session IS NOT NULL"
)

_ORDER_COLUMNS = "event_time, event_type, product_id, category_code, price, user_id, user_session"

_ORDER_LINES = """
order_lines AS (
  SELECT l_shipdate AS event_time,
    CASE l_returnflag WHEN 'N' THEN 'purchase' WHEN 'R' THEN 'cart' ELSE 'view' END AS event_type,
    l_partkey AS product_id,
    concat(lower(l_returnflag), '.', lower(l_linestatus), '.', l_linenumber) AS category_code,
    l_extendedprice AS price, l_suppkey AS user_id, CAST(l_orderkey AS VARCHAR) AS user_session
  FROM lineitem
)"""


def _deduplicated(raw: str, source: str, columns: str, order_by: str) -> str:
    return f"""{raw},
deduplicated AS (
  SELECT {columns} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_time, user_session, product_id
      ORDER BY CASE WHEN {_COMPLETE} THEN 0 ELSE 1 END, {order_by}) AS copy_number
    FROM {source}) copies
  WHERE copy_number = 1
)"""


def _clean(deduplicated: str) -> str:
    return f"""{deduplicated},
clean AS (SELECT * FROM deduplicated WHERE {_COMPLETE})"""


def _moved(clean: str) -> str:
    return f"""{clean},
moved AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY product_id, user_session ORDER BY event_time) AS INTEGER) AS purchase_movement
  FROM clean
)"""


def _report(source: str) -> str:
    return f"""
SELECT initial_rows, initial_rows - distinct_rows AS duplicate_rows,
  distinct_rows - final_rows AS incomplete_rows, final_rows
FROM (SELECT (SELECT COUNT(*) FROM {source}) AS initial_rows,
  (SELECT COUNT(*) FROM deduplicated) AS distinct_rows,
  (SELECT COUNT(*) FROM clean) AS final_rows) counted"""


_DEDUPLICATED = _deduplicated(_ACTIVITY_RAW, "activity_raw", _RAW_COLUMNS, "event_id")
_CLEAN = _clean(_DEDUPLICATED)
_MOVED = _moved(_CLEAN)
_ORDER_CLEAN = _clean(
    _deduplicated(_ORDER_LINES, "order_lines", _ORDER_COLUMNS, "event_type, category_code, price, user_id")
)
_ORDER_MOVED = _moved(_ORDER_CLEAN)

_CATALOGUE = """
catalogue AS (
  SELECT p_partkey AS product_id, CAST(p_size AS BIGINT) AS category_id, p_brand AS brand,
    CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN lower(p_type)
      WHEN 2 THEN concat(lower(p_type), '.', replace(p_name, ' ', '_'))
      WHEN 3 THEN concat(lower(p_type), '.', replace(p_name, ' ', '.'))
      WHEN 4 THEN concat(lower(p_type), '.', replace(p_name, ' ', '.'), '.x')
      ELSE concat(lower(p_type), '.', replace(p_name, ' ', '.'), '.x.y') END AS category_code
  FROM part
)"""

_REBRANDED = f"""{_CATALOGUE},
rebranded AS (
  SELECT product_id, category_id,
    CASE WHEN category_id > 25 THEN concat(brand, '-new') ELSE brand END AS brand, category_code
  FROM catalogue
)"""


def _levels(missing: str | None = None) -> str:
    parts = [f"string_split(category_code, '.')[{i}]" for i in range(1, len(HIERARCHY_COLUMNS) + 1)]
    if missing is not None:
        parts = [f"coalesce({part}, '{missing}')" for part in parts]
    return ", ".join(f"{part} AS {name}" for part, name in zip(parts, HIERARCHY_COLUMNS, strict=True))


def _products(source: str) -> str:
    return f"SELECT DISTINCT {_MASTER} FROM (SELECT *, {_levels()} FROM {source}) levelled"


_RANGE = "BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59'"
_ORDER_RANGE = "BETWEEN TIMESTAMP '1999-01-01 00:00:00' AND TIMESTAMP '2001-12-31 00:00:00'"
_EXACT = "CAST(price AS DECIMAL(18,4))"


def _sales_report(moved: str) -> str:
    return f"""{moved},
totals AS (
  SELECT product_id, CAST(SUM({_EXACT}) AS DOUBLE) AS total_sales,
    CAST(SUM(purchase_movement) AS BIGINT) AS total_purchase_movement
  FROM moved WHERE event_type = 'purchase' GROUP BY product_id
),
report AS (
  SELECT product_id, total_sales,
    CAST(CAST(total_sales * 100 / NULLIF(SUM(total_sales) OVER (), 0) AS DECIMAL(10,2)) AS DOUBLE)
      AS sales_percentage,
    total_purchase_movement,
    CASE WHEN total_purchase_movement = 0 THEN 0
      ELSE total_sales / total_purchase_movement END AS sales_per_movement
  FROM totals
)"""


def _daily(time_range: str) -> str:
    return f"""
SELECT CAST(event_time AS DATE) AS time, CAST(SUM({_EXACT}) AS DOUBLE) AS total_sales
FROM moved WHERE event_type = 'purchase' AND event_time {time_range} GROUP BY 1 ORDER BY 1"""


_TOTALS = _sales_report(_MOVED)
_ORDER_TOTALS = _sales_report(_ORDER_MOVED)

_TOP = "FROM report ORDER BY total_sales DESC NULLS FIRST, product_id LIMIT 10"


def _pairs(source: str, columns: list[str]) -> str:
    each = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST({name} AS VARCHAR) AS value FROM {source}" for name in columns
    )
    return f"""
pairs AS (SELECT DISTINCT column_name, value FROM ({each}) every_value),
counts AS (SELECT column_name, COUNT(value) AS unique_count FROM pairs GROUP BY column_name),
listed AS (
  SELECT column_name, CAST(position AS INTEGER) AS position, value FROM (
    SELECT pairs.column_name, value, unique_count, row_number() OVER (
      PARTITION BY pairs.column_name ORDER BY value NULLS FIRST) AS position
    FROM pairs JOIN counts ON pairs.column_name = counts.column_name) numbered
  WHERE position <= CASE WHEN unique_count < 15 THEN 15 ELSE 5 END
)"""


_EVENT_PAIRS = _pairs("events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
_RAW_PAIRS = _pairs("activity_raw", [name.strip() for name in _RAW_COLUMNS.split(",")])

_MOVEMENT = f"""WITH {_MOVED}
SELECT event_id, event_time, event_type, product_id, price, user_id, user_session, purchase_movement
FROM moved"""

_MERGED = f"WITH {_REBRANDED} {_products('catalogue')} UNION {_products('rebranded')}"

_ORDER_ACTIVITY = f"""WITH {_ORDER_MOVED}
SELECT {_ORDER_COLUMNS}, DATE '2024-02-01' AS processed_date, purchase_movement, {_levels('')} FROM moved"""

ORACLE_SQL: dict[str, str] = {
    "stamp_processed_date": (
        "SELECT event_id, ts, event_type, DATE '2024-02-01' AS processed_date FROM events"
    ),
    "cast_event_time": (
        "SELECT event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN 'no time' "
        "ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS event_time FROM events"
    ),
    "time_range_filter": f"SELECT event_id, ts AS event_time, user_id FROM events WHERE ts {_RANGE}",
    "purchases_only": (
        "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'purchase'"
    ),
    "dedup_events": f"WITH {_DEDUPLICATED} SELECT {_RAW_COLUMNS} FROM deduplicated",
    "drop_null_critical": f"WITH {_ACTIVITY_RAW} SELECT {_RAW_COLUMNS} FROM activity_raw WHERE {_COMPLETE}",
    "clean_events": (
        f"WITH {_CLEAN} SELECT {_RAW_COLUMNS}, DATE '2024-02-01' AS processed_date FROM clean"
    ),
    "preprocess_report": f"WITH {_CLEAN} {_report('activity_raw')}",
    "purchase_movement": _MOVEMENT,
    "purchase_movement_sliced": _MOVEMENT,
    "category_hierarchy_null": f"WITH {_CATALOGUE} SELECT *, {_levels()} FROM catalogue",
    "category_hierarchy_blank": f"WITH {_CATALOGUE} SELECT *, {_levels('')} FROM catalogue",
    "activity": f"""WITH {_MOVED}
SELECT {_RAW_COLUMNS}, DATE '2024-02-01' AS processed_date, purchase_movement, {_levels('')} FROM moved""",
    "product_projection": f"WITH {_CATALOGUE} SELECT {_MASTER} FROM (SELECT *, {_levels()} FROM catalogue) l",
    "distinct_products": f"WITH {_ACTIVITY_RAW} {_products('activity_raw')}",
    "union_by_name": f"""WITH {_REBRANDED}
SELECT product_id, category_id, category_code, CAST(NULL AS VARCHAR) AS brand FROM catalogue
UNION ALL SELECT product_id, category_id, category_code, brand FROM rebranded""",
    "product_master": _MERGED,
    "product_master_incremental": _MERGED,
    "new_master_rows": f"WITH {_REBRANDED} {_products('rebranded')} EXCEPT {_products('catalogue')}",
    "master_merge_empty_history": f"WITH {_CATALOGUE} {_products('catalogue')}",
    "daily_sales": f"WITH {_MOVED} {_daily(_RANGE)}",
    "product_sales": f"WITH {_TOTALS} SELECT product_id, total_sales, total_purchase_movement FROM report",
    "sales_share": f"WITH {_TOTALS} SELECT product_id, total_sales, sales_percentage FROM report",
    "sales_per_movement": (
        f"WITH {_TOTALS} SELECT product_id, total_sales, total_purchase_movement, sales_per_movement FROM report"
    ),
    "top_products": f"WITH {_TOTALS} SELECT * {_TOP}",
    "top_products_panel": f"WITH {_TOTALS} SELECT "
    + ", ".join(f'{name} AS "{label}"' for name, label in TOP_PRODUCT_LABELS.items())
    + f" {_TOP}",
    "daily_sales_sql": f"WITH {_MOVED} {_daily(_RANGE)}",
    "top_products_sql": f"WITH {_TOTALS} SELECT "
    + ", ".join(f'{name} AS "{label}"' for name, label in TOP_PRODUCT_LABELS.items())
    + f" {_TOP}",
    "order_line_report": f"WITH {_ORDER_CLEAN} {_report('order_lines')}",
    "order_line_activity": _ORDER_ACTIVITY,
    "order_line_activity_sliced": _ORDER_ACTIVITY,
    "order_line_daily_sales": f"WITH {_ORDER_MOVED} {_daily(_ORDER_RANGE)}",
    "order_line_top_products": f"WITH {_ORDER_TOTALS} SELECT * {_TOP}",
    "order_line_sales_share": f"WITH {_ORDER_TOTALS} SELECT product_id, total_sales, sales_percentage FROM report",
    "profile_unique_counts": f"WITH {_EVENT_PAIRS} SELECT column_name, unique_count FROM counts",
    "profile_sample_values": f"WITH {_EVENT_PAIRS} SELECT column_name, position, value FROM listed",
    "profile_activity": f"""WITH {_ACTIVITY_RAW}, {_RAW_PAIRS}
SELECT counts.column_name, unique_count,
  string_agg(coalesce(value, '(null)'), ',' ORDER BY position) AS listed_values
FROM counts JOIN listed ON counts.column_name = listed.column_name
GROUP BY counts.column_name, unique_count""",
    "backup_table_name": """SELECT doc_id, file_name,
  regexp_replace(concat('backup_', regexp_replace(file_name, '\\.[^.]*$', '')), '[^a-zA-Z0-9_]', '_', 'g')
    AS table_name
FROM (SELECT doc_id, concat('2024-', source, '-', lang, '.part.csv') AS file_name FROM documents) named""",
}

"""Names and types of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- Fixed values: names and types that stored tables and files must have ----

# The nine fields of a month file. The load date is added after reading: with a
# tenth field declared, a strict CSV mode would call every line malformed.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

EVENT_KEY = ["event_time", "user_session", "product_id"]
CRITICAL_COLUMNS = ["event_time", "event_type", "product_id", "user_id", "user_session"]
HIERARCHY_COLUMNS = [
    "category_hierarchy_1",
    "category_hierarchy_2",
    "category_hierarchy_3",
    "category_hierarchy_4",
]
MASTER_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType(), nullable=False),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("category_hierarchy_1", T.StringType()),
        T.StructField("category_hierarchy_2", T.StringType()),
        T.StructField("category_hierarchy_3", T.StringType()),
        T.StructField("category_hierarchy_4", T.StringType()),
        T.StructField("brand", T.StringType()),
    ]
)
ACTIVITY_TABLE = "webshop_activity_data"
MASTER_TABLE = "product_master_data"
BACKUP_PREFIX = "backup_"
BACKUP_UNSAFE_CHARACTERS = "[^a-zA-Z0-9_]"
CATEGORY_SEPARATOR = r"\."
PURCHASE = "purchase"
TOP_PRODUCT_LABELS = {
    "product_id": "Product ID",
    "total_sales": "Total Sales",
    "sales_percentage": "Sales Percentage",
    "total_purchase_movement": "Total Purchase Movement",
    "sales_per_movement": "Sales per Purchase Movement",
}
DASHBOARD_FROM = "2019-09-01T00:00:00Z"
DASHBOARD_TO = "2020-01-31T23:59:59Z"
LISTED_WHEN_FEW = 15
LISTED_WHEN_MANY = 5

# ---- End of fixed values ----

MASTER_COLUMNS = MASTER_SCHEMA.fieldNames()

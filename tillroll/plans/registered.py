"""Every registered query: one callable per operator, over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import operators as op
from tillroll.functions import table_name_for_file
from tillroll.plans import fixtures as fx
from tillroll.plans import panels
from tillroll.plans.fixtures import table
from tillroll.schemas import ACTIVITY_TABLE, CRITICAL_COLUMNS, MASTER_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

LOAD_DATE = dt.date(2024, 2, 1)
FROM, TO = "2024-01-05 00:00:00", "2024-01-20 23:59:59"


def stamp_processed_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return op.stamp_processed_date(events, LOAD_DATE)


def cast_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", "no time").otherwise(F.col("ts").cast("string"))
    events = table(spark, sf_dir, "events").select("event_id", text.alias("event_time"))
    return op.cast_event_time(events).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def time_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("event_time"), "user_id")
    return op.in_time_range(events, FROM, TO)


def purchases_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.purchases(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"))


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.deduplicate(fx.activity_raw(spark, sf_dir), order_by=["event_id"])


def drop_null_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.drop_incomplete(fx.activity_raw(spark, sf_dir), CRITICAL_COLUMNS)


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_events(fx.activity_raw(spark, sf_dir), LOAD_DATE, order_by=["event_id"])


def preprocess_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.cleaning_report(fx.activity_raw(spark, sf_dir))


def purchase_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_purchase_movement(_movement_input(spark, sf_dir))


def purchase_movement_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.add_purchase_movement_sliced(_movement_input(spark, sf_dir), "day")


def _movement_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.clean(spark, sf_dir).select(
        "event_id", "event_time", "event_type", "product_id", "price", "user_id", "user_session"
    )


def category_hierarchy_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.split_category(fx.catalogue(spark, sf_dir))


def category_hierarchy_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.split_category(fx.catalogue(spark, sf_dir), missing="")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.build_activity(clean_events(spark, sf_dir))


def product_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.split_category(fx.catalogue(spark, sf_dir)).select(*MASTER_COLUMNS)


def distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.product_rows(fx.activity_raw(spark, sf_dir))


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.union_by_name(
        fx.catalogue(spark, sf_dir).drop("brand"), fx.rebranded_catalogue(spark, sf_dir)
    )


def _history_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (
        op.product_rows(fx.catalogue(spark, sf_dir)),
        op.product_rows(fx.rebranded_catalogue(spark, sf_dir)),
    )


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.merge_master(*_history_and_batch(spark, sf_dir))


def product_master_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    history, batch = _history_and_batch(spark, sf_dir)
    return history.unionByName(op.new_master_rows(history, batch))


def new_master_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.new_master_rows(*_history_and_batch(spark, sf_dir))


def master_merge_empty_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.merge_master(op.empty_master(spark), op.product_rows(fx.catalogue(spark, sf_dir)))


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.daily_sales(fx.moved(spark, sf_dir), FROM, TO)


def product_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.product_sales(fx.moved(spark, sf_dir))


def sales_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(op.sales_share(fx.moved(spark, sf_dir)), "sales_percentage")


def sales_per_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.sales_per_movement(fx.moved(spark, sf_dir))


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(op.top_products(fx.moved(spark, sf_dir)), "sales_percentage")


def top_products_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(op.top_products(fx.moved(spark, sf_dir), labels=True), "Sales Percentage")


def order_line_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.cleaning_report(fx.order_lines(spark, sf_dir))


def order_line_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.build_activity(op.clean_events(fx.order_lines(spark, sf_dir), LOAD_DATE))


def order_line_activity_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.build_activity(op.clean_events(fx.order_lines(spark, sf_dir), LOAD_DATE), slice_width="day")


def order_line_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.daily_sales(order_line_activity(spark, sf_dir), "1999-01-01", "2001-12-31 00:00:00")


def order_line_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(op.top_products(order_line_activity(spark, sf_dir)), "sales_percentage")


def order_line_sales_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_double(op.sales_share(order_line_activity(spark, sf_dir)), "sales_percentage")


def daily_sales_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {ACTIVITY_TABLE: fx.moved(spark, sf_dir)}
    return panels.run_panel(spark, panels.DAILY_SALES, FROM, TO, kind="timestamp_ntz", tables=tables)


def top_products_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = panels.run_panel(spark, panels.TOP_PRODUCTS, tables={ACTIVITY_TABLE: fx.moved(spark, sf_dir)})
    return _as_double(found, "Sales Percentage")


def _as_double(df: DataFrame, name: str) -> DataFrame:
    """DECIMAL(10,2) as DOUBLE, the one numeric type both engines hand out alike."""
    return df.withColumn(name, F.col(name).cast("double"))


def profile_unique_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unique_counts(table(spark, sf_dir, "events"))


def profile_sample_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.sample_values(table(spark, sf_dir, "events"))


def profile_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = op.profile(fx.activity_raw(spark, sf_dir))
    return listed.withColumn("listed_values", F.array_join("listed_values", ",", "(null)"))


def backup_table_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    file_name = F.concat_ws("-", F.lit("2024"), "source", F.concat("lang", F.lit(".part.csv")))
    documents = table(spark, sf_dir, "documents").select("doc_id", file_name.alias("file_name"))
    return documents.withColumn("table_name", table_name_for_file(F.col("file_name")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        stamp_processed_date,
        cast_event_time,
        time_range_filter,
        purchases_only,
        dedup_events,
        drop_null_critical,
        clean_events,
        preprocess_report,
        purchase_movement,
        purchase_movement_sliced,
        category_hierarchy_null,
        category_hierarchy_blank,
        activity,
        product_projection,
        distinct_products,
        union_by_name,
        product_master,
        product_master_incremental,
        new_master_rows,
        master_merge_empty_history,
        daily_sales,
        product_sales,
        sales_share,
        sales_per_movement,
        top_products,
        top_products_panel,
        daily_sales_sql,
        top_products_sql,
        order_line_report,
        order_line_activity,
        order_line_activity_sliced,
        order_line_daily_sales,
        order_line_top_products,
        order_line_sales_share,
        profile_unique_counts,
        profile_sample_values,
        profile_activity,
        backup_table_name,
    )
}

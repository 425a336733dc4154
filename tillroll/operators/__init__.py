from tillroll.operators.category import split_category
from tillroll.operators.cleaning import (
    cast_event_time,
    clean_events,
    cleaning_report,
    complete_rows,
    drop_incomplete,
    stamp_processed_date,
)
from tillroll.operators.dedup import deduplicate
from tillroll.operators.master import (
    empty_master,
    merge_master,
    new_master_rows,
    product_rows,
    union_by_name,
)
from tillroll.operators.movement import (
    SLICE_WIDTHS,
    add_purchase_movement,
    add_purchase_movement_sliced,
    build_activity,
)
from tillroll.operators.profiling import preview, profile, sample_values, unique_counts
from tillroll.operators.sales import (
    daily_sales,
    in_time_range,
    product_sales,
    purchases,
    sales_per_movement,
    sales_share,
    top_products,
)

__all__ = [
    "SLICE_WIDTHS",
    "add_purchase_movement",
    "add_purchase_movement_sliced",
    "build_activity",
    "cast_event_time",
    "clean_events",
    "cleaning_report",
    "complete_rows",
    "daily_sales",
    "deduplicate",
    "drop_incomplete",
    "empty_master",
    "in_time_range",
    "merge_master",
    "new_master_rows",
    "preview",
    "product_rows",
    "product_sales",
    "profile",
    "purchases",
    "sales_per_movement",
    "sales_share",
    "sample_values",
    "split_category",
    "stamp_processed_date",
    "top_products",
    "union_by_name",
    "unique_counts",
]

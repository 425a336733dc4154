"""Running number of each event of a product within a session."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import parse_time
from tillroll.operators.category import split_category
from tillroll.operators.guards import require_columns

GROUP = ["product_id", "user_session"]
SLICE_WIDTHS = ("hour", "day")


def _with_time(df: DataFrame) -> DataFrame:
    require_columns(df, [*GROUP, "event_time"], "add_purchase_movement")
    if df.schema["event_time"].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        return df
    return df.withColumn("event_time", parse_time(F.col("event_time")))


def add_purchase_movement(df: DataFrame) -> DataFrame:
    """Number all events of a (product, session) by time, whatever their type.

    One shuffle. A group is sorted by one task: after duplicate removal it has at
    most one row per distinct time, e.g. 2.7 million in a month of whole seconds.
    For input without such a bound use :func:`add_purchase_movement_sliced`.
    """
    by_time = Window.partitionBy(*GROUP).orderBy("event_time")
    return _with_time(df).withColumn("purchase_movement", F.row_number().over(by_time))


def add_purchase_movement_sliced(df: DataFrame, width: str = "day") -> DataFrame:
    """The same numbers with each group cut into time slices.

    Rows are numbered within (product, session, slice), so a group that holds a large
    part of all rows is spread over many tasks; to that is added how many rows the
    group has in earlier slices, from one counted row per slice. Only groups longer
    than one slice have such a count. The key is one struct column because structs
    compare NULL fields as equal: the join then keeps NULL groups and needs no second
    shuffle of the events. Reads its input twice, so give it a stored table.
    """
    if width not in SLICE_WIDTHS:
        raise ValueError(f"slice width {width!r} is none of {', '.join(SLICE_WIDTHS)}")
    slice_key = F.struct(*GROUP, F.date_trunc(width, "event_time").alias("slice"))
    sliced = _with_time(df).withColumn("_slice", slice_key)
    in_slice = Window.partitionBy("_slice").orderBy("event_time")
    numbered = sliced.withColumn("_number", F.row_number().over(in_slice))

    earlier = (
        Window.partitionBy(*[f"_slice.{name}" for name in GROUP])
        .orderBy("_slice.slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_slice", F.sum("_rows").over(earlier).alias("_before"))
        .where(F.col("_before") > 0)
    )
    number = F.col("_number") + F.coalesce(F.col("_before"), F.lit(0))
    return (
        numbered.join(offsets, "_slice", "left")
        .withColumn("purchase_movement", number.cast("int"))
        .drop("_slice", "_number", "_before")
    )


def build_activity(df: DataFrame, slice_width: str | None = None) -> DataFrame:
    """Staged events to activity rows: blank-filled levels and purchase movement.

    ``slice_width`` numbers groups in slices of time, see :func:`add_purchase_movement_sliced`.
    """
    numbered = add_purchase_movement_sliced(df, slice_width) if slice_width else add_purchase_movement(df)
    return numbered.transform(split_category, missing="")

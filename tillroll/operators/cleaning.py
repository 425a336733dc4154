"""From raw events to complete, duplicate-free ones, with a count of what went."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import parse_time
from tillroll.operators.dedup import deduplicate, incomplete
from tillroll.operators.guards import require_columns
from tillroll.schemas import CRITICAL_COLUMNS, EVENT_KEY


def drop_incomplete(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    require_columns(df, columns, "drop_incomplete")
    return df.dropna(subset=list(columns))


def stamp_processed_date(df: DataFrame, batch_date: dt.date | None = None) -> DataFrame:
    """Set ``processed_date``, today unless a date is given."""
    date = F.current_date() if batch_date is None else F.lit(batch_date)
    return df.withColumn("processed_date", date)


def cast_event_time(df: DataFrame) -> DataFrame:
    require_columns(df, ["event_time"], "cast_event_time")
    return df.withColumn("event_time", parse_time(F.col("event_time")))


def clean_events(
    df: DataFrame,
    batch_date: dt.date | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Duplicates out first, then incomplete rows, then the load date on.

    The order matters: it decides in which count of the report a row falls.
    """
    return df.transform(deduplicate, order_by=order_by).transform(drop_incomplete).transform(
        stamp_processed_date, batch_date
    )


def complete_rows(deduplicated: DataFrame) -> DataFrame:
    """Flag the rows that pass the NULL check, without dropping the others."""
    return deduplicated.withColumn("is_complete", ~incomplete(CRITICAL_COLUMNS))


def cleaning_report(df: DataFrame) -> DataFrame:
    """One row: rows read, dropped as duplicates, dropped as incomplete, left.

    A key leaves a complete row exactly if one of its rows is complete, so one hash
    aggregate over the critical columns counts all four. These are query results
    rather than accumulators, so a task that runs twice does not count twice.
    """
    require_columns(df, CRITICAL_COLUMNS, "cleaning_report")
    complete = F.when(incomplete(CRITICAL_COLUMNS), 0).otherwise(1)
    per_key = df.groupBy(*EVENT_KEY).agg(
        F.count(F.lit(1)).alias("copies"), F.max(complete).alias("complete")
    )
    return report_of(per_key)


def report_of(per_key: DataFrame) -> DataFrame:
    """The report from one row per key with its ``copies`` and 0/1 ``complete``."""
    totals = per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("initial_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("complete").cast("long")), F.lit(0)).alias("final_rows"),
    )
    return totals.select(
        "initial_rows",
        (F.col("initial_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
        (F.col("distinct_rows") - F.col("final_rows")).alias("incomplete_rows"),
        "final_rows",
    )

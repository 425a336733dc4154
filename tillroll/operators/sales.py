"""Sales reports over the activity table."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import (
    day_of,
    from_units,
    parse_time,
    ratio,
    sum_of_odd,
    sum_of_prices,
    to_units,
)
from tillroll.schemas import PURCHASE, TOP_PRODUCT_LABELS


def purchases(df: DataFrame) -> DataFrame:
    return df.where(F.col("event_type") == PURCHASE)


Time = str | dt.date | dt.datetime


def _bound(time: Time, kind: str) -> Column:
    return F.lit(time).cast(kind)


def _is_day(time: Time) -> bool:
    """A date without a time of day."""
    if isinstance(time, str):
        return re.fullmatch(r"\s*\d{4}-\d{1,2}-\d{1,2}\s*", time) is not None
    return not isinstance(time, dt.datetime)


def in_time_range(df: DataFrame, start: Time, end: Time) -> DataFrame:
    """Events from ``start`` to ``end``, both included; an ``end`` without a time of day is
    the whole day. A text ``event_time`` is parsed, and NULL where it is no time.

    A table stored by day (``event_date``) is also filtered on its days, so that whole
    partitions are left unread. The days are those of the session that wrote them, so one
    more is read at either end; the times decide.
    """
    kind = df.schema["event_time"].dataType.typeName()
    time = F.col("event_time")
    if kind not in ("timestamp", "timestamp_ntz"):
        kind, time = "timestamp", parse_time(time)
    low, high = _bound(start, kind), _bound(end, kind)
    if _is_day(end):
        after = (high + F.expr("INTERVAL 1 DAY")).cast(kind)
        wanted, last = (time >= low) & (time < after), day_of(high)
    else:
        wanted, last = time.between(low, high), day_of(high)
    if "event_date" in df.columns:
        wanted = wanted & F.col("event_date").between(F.date_sub(day_of(low), 1), F.date_add(last, 1))
    return df.where(wanted)


def daily_sales(df: DataFrame, start: Time, end: Time) -> DataFrame:
    """Sales per day of a time range, by day."""
    time = F.col("event_time")
    if df.schema["event_time"].dataType.typeName() == "string":
        time = parse_time(time)
    return (
        purchases(in_time_range(df, start, end))
        .groupBy(day_of(time).alias("time"))
        .agg(sum_of_prices(F.col("price")).alias("total_sales"))
        .orderBy("time")
    )


def _product_totals(df: DataFrame, with_movement: bool) -> DataFrame:
    sums = [F.sum(to_units(F.col("price"))).alias("sales"), sum_of_odd(F.col("price")).alias("odd")]
    if with_movement:
        sums.append(F.sum(F.col("purchase_movement").cast("long")).alias("movement"))
    return purchases(df).groupBy("product_id").agg(*sums)


def _share(totals: DataFrame) -> Column:
    """Percent of all sales, as a one-value subquery on the same aggregate; NULL if a sum is
    not finite, as a decimal cannot hold that.

    A window over all products would bring one row per product to one task. The subquery
    asks for every sum of ``totals``, which gives it the same shuffle as the report: the
    shuffle is then made once and read twice.
    """
    sums = [F.sum(name).alias(name) for name in totals.columns if name != "product_id"]
    everything = totals.agg(F.struct(*sums)).scalar()
    finite = everything["odd"].isNull() & F.col("odd").isNull()
    percent = F.when(finite, F.col("sales").cast("double") * 100)
    return ratio(percent, everything["sales"], F.lit(None).cast("double")).cast("decimal(10,2)")


def _report(df: DataFrame, *columns: str) -> DataFrame:
    with_movement = {"total_purchase_movement", "sales_per_movement"} & set(columns)
    totals = _product_totals(df, bool(with_movement))
    sales, movement = F.coalesce("odd", from_units(F.col("sales"))), F.col("movement")
    formulas = {
        "total_sales": lambda: sales,
        "sales_percentage": lambda: _share(totals),
        "total_purchase_movement": lambda: movement,
        "sales_per_movement": lambda: ratio(sales, movement, F.lit(0.0)),
    }
    return totals.select("product_id", *[formulas[name]().alias(name) for name in columns])


def product_sales(df: DataFrame) -> DataFrame:
    """Sales and movement of every purchased product."""
    return _report(df, "total_sales", "total_purchase_movement")


def sales_share(df: DataFrame) -> DataFrame:
    """Sales of every purchased product and its percentage of all sales."""
    return _report(df, "total_sales", "sales_percentage")


def sales_per_movement(df: DataFrame) -> DataFrame:
    """Sales per purchase movement, 0 where the movements sum to 0."""
    return _report(df, "total_sales", "total_purchase_movement", "sales_per_movement")


def top_products(df: DataFrame, n: int = 10, labels: bool = False) -> DataFrame:
    """The ``n`` products with most sales; percentages refer to all products.

    Products without any price (NULL sales) come first, equal sales by product id.
    ``labels`` gives the columns their dashboard titles.
    """
    report = _report(
        df, "total_sales", "sales_percentage", "total_purchase_movement", "sales_per_movement"
    )
    top = report.orderBy(F.desc_nulls_first("total_sales"), "product_id").limit(n)
    return top.withColumnsRenamed(TOP_PRODUCT_LABELS) if labels else top

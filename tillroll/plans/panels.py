"""Dashboard panels as SQL text over stored tables.

A panel is a query as dashboards keep it, with macros for the time range that is shown:
``$__timeFilter(column)``, ``$__timeFrom()`` and ``$__timeTo()``. They become typed parameters
of ``spark.sql``, never text of the query. Names in double quotes are identifiers, and
``value::type`` is a cast, as in the databases that such panels were written for. Other than
there, Spark sorts NULL first in ascending and last in descending order unless told otherwise.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import ACTIVITY_TABLE

Time = str | dt.date | dt.datetime

#: Both are needed for Spark to take "a name" for a name and not for a text.
QUOTED_NAMES = {"spark.sql.ansi.enabled": "true", "spark.sql.ansi.doubleQuotedIdentifiers": "true"}
PARAMETERS = ("time_from", "time_to")
MACRO = re.compile(r"\$__(\w+)\(\s*([\w.]*)\s*\)")

#: Sales by day of the time that is shown. Prices are summed in whole hundredths of a cent, so
#: that the order of the rows doesn't matter; those that are no number count as missing.
DAILY_SALES = f"""
SELECT event_time::date AS time, (sum(try_cast(round(price * 10000) AS bigint)) / 10000.0)::double AS total_sales
FROM {ACTIVITY_TABLE}
WHERE event_type = 'purchase' AND $__timeFilter(event_time)
GROUP BY event_time::date
ORDER BY time
"""

#: The ten products with most sales of all times. The total of all products is a subquery, as a
#: window would bring every product to one task. It asks for both sums, which gives it the
#: same shuffle as the report.
TOP_PRODUCTS = f"""
WITH totals AS (
  SELECT product_id, sum(try_cast(round(price * 10000) AS bigint)) AS sales, sum(purchase_movement::bigint) AS movement
  FROM {ACTIVITY_TABLE}
  WHERE event_type = 'purchase'
  GROUP BY product_id)
SELECT product_id AS "Product ID",
  (sales / 10000.0)::double AS "Total Sales",
  (sales::double * 100 / nullif((SELECT struct(sum(sales) AS sales, sum(movement)) FROM totals).sales, 0))::numeric(10, 2) AS "Sales Percentage",
  movement AS "Total Purchase Movement",
  CASE WHEN movement = 0 THEN 0::double ELSE sales / 10000.0::double / movement END AS "Sales per Purchase Movement"
FROM totals
ORDER BY "Total Sales" DESC NULLS FIRST, "Product ID"
LIMIT 10
"""


def expand(sql: str, day_column: str | None = None, kind: str = "timestamp") -> str:
    """``sql`` with its macros as the parameters ``:time_from`` and ``:time_to``, cast to ``kind``.

    With ``day_column``, the date column that the table is stored by, a time filter also
    names the days, so that other partitions are left unread. The days are those of the
    session that wrote them, so one more is read at either end; the times decide. A macro of
    another name raises ``ValueError``.
    """

    if kind not in ("timestamp", "timestamp_ntz"):
        raise ValueError(f"not a type of time: {kind}")
    low, high = (f"CAST(:{name} AS {kind})" for name in PARAMETERS)

    def expanded(macro: re.Match) -> str:
        name, column = macro.groups()
        if name == "timeFilter" and column:
            times = f"{column} BETWEEN {low} AND {high}"
            days = f"{day_column} BETWEEN date_sub({low}, 1) AND date_add({high}, 1)"
            return f"({times} AND {days})" if day_column else f"({times})"
        if name in ("timeFrom", "timeTo") and not column:
            return low if name == "timeFrom" else high
        raise ValueError(f"unknown macro {macro[0]}")

    return MACRO.sub(expanded, sql)


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session while a query is read; they are put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def _views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[None]:
    made = []
    try:
        for name, df in tables.items():
            df.createTempView(name)
            made.append(name)
        yield
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def run_panel(
    spark: SparkSession,
    sql: str,
    start: Time | None = None,
    end: Time | None = None,
    day_column: str | None = None,
    kind: str = "timestamp",
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The result of a panel's query, over the session's tables and views.

    ``tables`` are data frames that the query may name as well; the names must be free, and
    are so again afterwards.
    ``start`` and ``end`` are both included and needed if the query has macros; they are
    values of the type ``kind`` (``timestamp_ntz`` for columns without a zone). The query is
    planned like any other: filters and columns reach the scan. One without macros runs as
    it is.
    """
    wanted = expand(sql, day_column, kind)
    if wanted != sql and (start is None or end is None):
        raise ValueError("the panel shows a time range; start and end are needed")
    times = dict(zip(PARAMETERS, (start, end), strict=True)) if wanted != sql else None
    with _settings(spark, QUOTED_NAMES), _views(spark, tables or {}):
        found = spark.sql(wanted, times)
        found.schema  # the names are found while the settings hold
    return found

"""Panels as SQL text: macros, names in quotes, plans, and the same results as the operators."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.compare import rows_of
from tillroll import operators as op
from tillroll.jobs import main
from tillroll.plans import panels
from tillroll.schemas import ACTIVITY_TABLE
from tillroll.sources import drop_table

TIMES = ("2020-01-01 00:00:00", "2020-01-03 12:00:00")


def activity(spark):
    rows = [
        (1, "2020-01-01 00:00:00", "purchase", 10.255, 1), (1, "2020-01-03 12:00:00", "purchase", 0.1, 2),
        (2, "2020-01-03 12:00:01", "purchase", 5.0, 1), (2, "2020-01-02 01:00:00", "view", 7.0, 2),
        (3, "2019-12-31 23:59:59", "purchase", None, 1), (4, "2020-01-02 23:00:00", "purchase", 3.5, 0)]
    df = spark.createDataFrame(rows, "product_id long, event_time string, event_type string, price double, purchase_movement int")
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def same(ours, theirs):
    assert ours.columns == theirs.columns
    assert [tuple(r) for r in ours.collect()] == [tuple(r) for r in theirs.collect()]


def test_panels_equal_the_operators(spark):
    df = activity(spark)
    tables = {ACTIVITY_TABLE: df}
    same(panels.run_panel(spark, panels.DAILY_SALES, *TIMES, tables=tables), op.daily_sales(df, *TIMES))
    same(panels.run_panel(spark, panels.TOP_PRODUCTS, tables=tables), op.top_products(df, labels=True))
    empty = {ACTIVITY_TABLE: df.limit(0)}
    assert panels.run_panel(spark, panels.TOP_PRODUCTS, tables=empty).count() == 0
    odd = df.withColumn("price", F.when(F.col("product_id") == 4, float("nan")).otherwise(F.col("price")))
    found = panels.run_panel(spark, panels.TOP_PRODUCTS, tables={ACTIVITY_TABLE: odd}).collect()
    assert [r["Product ID"] for r in found] == [3, 4, 1, 2] and found[1]["Total Sales"] is None


def test_any_query_with_macros_and_quoted_names(spark):
    sql = """SELECT count(*) AS "Number of Events", $__timeFrom() AS low, $__timeTo( ) AS high,
      min(event_time)::date AS "First", sum(price)::numeric(10,2) AS s, sum(sum(price)) OVER () AS all_sales
      FROM shop WHERE $__timeFilter( shop.event_time ) OR event_type = '$5 "quoted" text'"""
    row = panels.run_panel(spark, sql, dt.datetime(2020, 1, 1), TIMES[1], tables={"shop": activity(spark)}).first()
    assert row["Number of Events"] == 4 and row["First"] == dt.date(2020, 1, 1) and str(row["s"]) == "20.86"
    assert (row["low"], row["high"]) == (dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 3, 12))


def test_times_are_values_and_never_text_of_the_query(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        panels.run_panel(spark, panels.DAILY_SALES, "2020-01-01' OR '1' = '1", TIMES[1], tables={ACTIVITY_TABLE: activity(spark)}).collect()


def test_what_is_refused(spark):
    with pytest.raises(ValueError, match="unknown macro"):
        panels.expand("SELECT $__interval()")
    with pytest.raises(ValueError, match="unknown macro"):
        panels.expand("SELECT $__timeFilter()")
    with pytest.raises(ValueError, match="start and end"):
        panels.run_panel(spark, panels.DAILY_SALES, start=TIMES[0])
    with pytest.raises(ValueError, match="type of time"):
        panels.expand("SELECT 1", kind="date")


def test_session_is_as_before(spark):
    before = {key: spark.conf.get(key, None) for key in panels.QUOTED_NAMES}
    found = panels.run_panel(spark, 'SELECT product_id AS "a b" FROM shop', tables={"shop": activity(spark)})
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        panels.run_panel(spark, "SELECT * FROM nowhere", tables={"shop": activity(spark)})
    assert found.columns == ["a b"] and found.count() == 6  # also after the view is gone
    assert {key: spark.conf.get(key, None) for key in panels.QUOTED_NAMES} == before
    assert not spark.catalog.tableExists("shop")
    assert spark.sql('SELECT "text" AS t').first().t == "text"


def test_plans(spark, tmp_path):
    by_day = activity(spark).withColumn("event_date", F.to_date("event_time"))
    by_day.write.partitionBy("event_date").parquet(str(tmp_path / "stored"))
    tables = {ACTIVITY_TABLE: spark.read.parquet(str(tmp_path / "stored"))}
    found = panels.run_panel(spark, panels.DAILY_SALES, *TIMES, day_column="event_date", tables=tables)
    scan = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line)
    assert "event_date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(e" in scan and "product_id" not in scan.split("ReadSchema")[1]
    same(found, op.daily_sales(activity(spark), *TIMES))

    top = panels.run_panel(spark, panels.TOP_PRODUCTS, tables=tables)
    top.collect()
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=10" in plan and "Window" not in plan and "ReusedExchange" in plan


def test_panel_job(spark, tmp_path):
    activity(spark).write.mode("overwrite").saveAsTable("panel_activity")
    file = tmp_path / "panel.sql"
    file.write_text(panels.DAILY_SALES.replace(ACTIVITY_TABLE, "panel_activity"))
    out = str(tmp_path / "days")
    main(["panel", "--sql-file", str(file), "--start", TIMES[0], "--end", TIMES[1], "--output", out], spark)
    stored = spark.read.parquet(out)
    expected = op.daily_sales(spark.table("panel_activity"), *TIMES)
    assert rows_of(stored.columns, stored.collect()) == rows_of(expected.columns, expected.collect())
    with pytest.raises(SystemExit):
        main(["panel", "--output", out], spark)
    drop_table(spark, "panel_activity")

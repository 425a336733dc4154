from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tests import mini
from tillroll import operators as op
from tillroll.schemas import TOP_PRODUCT_LABELS

SCHEMA = "event_time timestamp, event_type string, product_id long, price double, purchase_movement int"


@pytest.fixture
def activity(spark):
    t = mini.time
    return spark.createDataFrame(
        [
            (t(0), "purchase", 1, 10.10, 1),
            (t(5, 2), "purchase", 1, 20.20, 2),
            (t(5, 2), "purchase", 2, None, 1),
            (t(6, 2), "purchase", 3, 9.70, 0),
            (t(7, 2), "purchase", 4, -5.00, None),
            (t(7, 2), "view", 5, 1000.0, 1),
        ],
        SCHEMA,
    )


def test_top_products(activity):
    rows = op.top_products(activity).collect()
    assert [r.product_id for r in rows] == [2, 1, 3, 4]
    assert [r.total_sales for r in rows] == [None, 30.30, 9.70, -5.0]
    # 30.3 / 35.0, 9.7 / 35.0, -5 / 35.0
    assert [None if r.sales_percentage is None else str(r.sales_percentage) for r in rows] == [
        None, "86.57", "27.71", "-14.29"]
    assert [r.sales_per_movement for r in rows] == [None, 10.1, 0.0, None]
    assert dict(op.top_products(activity).dtypes)["sales_percentage"] == "decimal(10,2)"


def test_percentages_refer_to_all_products(activity):
    assert [str(r.sales_percentage) for r in op.top_products(activity.where("product_id <> 2"), 1).collect()] == ["86.57"]
    assert abs(sum(r.sales_percentage or 0 for r in op.sales_share(activity).collect()) - 100) < 0.05


def test_labels(activity):
    assert op.top_products(activity, labels=True).columns == list(TOP_PRODUCT_LABELS.values())


def test_no_sales_at_all(activity):
    assert op.top_products(activity.where("false")).count() == 0
    free = op.top_products(activity.where("product_id = 2")).collect()
    assert [(r.total_sales, r.sales_percentage) for r in free] == [(None, None)]


def test_zero_total_gives_no_percentage(spark):
    df = spark.createDataFrame([(mini.time(0), "purchase", 1, 0.0, 1)], SCHEMA)
    assert op.top_products(df).first().sales_percentage is None


def test_ties_by_product(spark):
    df = spark.createDataFrame([(mini.time(0), "purchase", p, 1.0, 1) for p in (3, 1, 2)], SCHEMA)
    assert [r.product_id for r in op.top_products(df, 2).collect()] == [1, 2]


def test_daily_sales(activity):
    rows = op.daily_sales(activity, "2019-09-01", "2020-01-31").collect()
    assert [(r.time, r.total_sales) for r in rows] == [
        (dt.date(2019, 10, 1), 10.10), (dt.date(2019, 10, 2), 24.90)]


def test_range_includes_both_ends(activity):
    assert op.in_time_range(activity, "2019-10-02 00:00:05", "2019-10-02 00:00:06").count() == 3
    assert op.in_time_range(activity, mini.time(0), mini.time(0)).count() == 1
    assert op.daily_sales(activity, "2021-01-01", "2021-01-02").count() == 0


def test_sums_are_exact(spark):
    df = spark.createDataFrame([(mini.time(0), "purchase", 1, 0.1, 1)] * 10, SCHEMA)
    assert op.product_sales(df).first().total_sales == 1.0
    assert op.product_sales(df).first().total_purchase_movement == 10


def test_range_is_asked_for(activity):
    with pytest.raises(TypeError):
        op.daily_sales(activity)


def test_a_date_as_end_is_its_whole_day(activity):
    whole = op.in_time_range(activity, "2019-10-02", "2019-10-02 23:59:59").count()
    assert whole > 0
    for end in ("2019-10-02", dt.date(2019, 10, 2)):
        assert op.in_time_range(activity, "2019-10-02", end).count() == whole
    assert op.in_time_range(activity, "2019-10-02", dt.datetime(2019, 10, 2)).count() < whole


def test_text_times_are_parsed(activity):
    text = activity.withColumn("event_time", F.col("event_time").cast("string"))
    assert op.in_time_range(text, "2019-10-02", "2019-10-02").count() == op.in_time_range(
        activity, "2019-10-02", "2019-10-02").count()
    assert op.daily_sales(text, "2019-10-01", "2019-10-02").collect() == op.daily_sales(
        activity, "2019-10-01", "2019-10-02").collect()


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Tokyo"])
def test_days_of_another_zone(spark, tmp_path, zone):
    rows = [(dt.datetime(2019, 10, day, hour), "purchase", 1, 1.0, 1) for day in range(1, 6) for hour in (0, 12, 23)]
    by_day = spark.createDataFrame(rows, SCHEMA).withColumn("event_date", F.to_date("event_time"))
    by_day.write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stored = spark.read.parquet(str(tmp_path / "t"))
        wanted = ("2019-10-02 20:00:00", "2019-10-03 05:00:00")
        pruned = op.in_time_range(stored, *wanted)
        assert pruned.count() == op.in_time_range(stored.drop("event_date"), *wanted).count() > 0
        assert "event_date" in pruned._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_odd_prices_spoil_only_their_own_sums(spark):
    nan, inf = float("nan"), float("inf")
    prices = [(1, 2.5), (1, 1.5), (2, nan), (2, 1.0), (3, inf), (4, inf), (4, -inf), (5, None)]
    df = spark.createDataFrame([(mini.time(0), "purchase", p, price, 2) for p, price in prices], SCHEMA)
    sums = {r.product_id: r.total_sales for r in op.product_sales(df).collect()}
    assert sums[1] == 4.0 and sums[3] == inf and sums[5] is None
    assert math.isnan(sums[2]) and math.isnan(sums[4])
    per_move = {r.product_id: r.sales_per_movement for r in op.sales_per_movement(df).collect()}
    assert per_move[1] == 1.0 and per_move[3] == inf and math.isnan(per_move[2])
    assert {r.sales_percentage for r in op.sales_share(df).collect()} == {None}
    # No sum first, then NaN, which is the largest number.
    assert [r.product_id for r in op.top_products(df, 4).collect()] == [5, 2, 4, 3]
    assert math.isnan(op.daily_sales(df, "2019-10-01", "2019-10-01").first().total_sales)
    finite = df.where("product_id = 1")
    assert op.daily_sales(finite, "2019-10-01", "2019-10-01").first().total_sales == 4.0
    assert float(op.sales_share(finite).first().sales_percentage) == 100.0

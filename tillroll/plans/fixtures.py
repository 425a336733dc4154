"""The generic test tables in the shape of web-shop tables.

Times are cut to the hour to get duplicate keys; codes have zero to five levels;
sessions and small prices are partly NULL. Every function reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import add_purchase_movement, clean_events, deduplicate, drop_incomplete


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(number: Column, *values: Column | str | None) -> Column:
    """``values[number]``, the last value beyond that."""
    *first, last = [value if isinstance(value, Column) else F.lit(value) for value in values]
    case = F
    for position, value in enumerate(first):
        case = case.when(number == position, value)
    return case.otherwise(last)


def activity_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw web-shop events."""
    # Taken from the text {"k": <number>} once, in a step of its own.
    events = table(spark, sf_dir, "events").withColumn(
        "number", F.regexp_extract("props", r'"k":\s*(\d+)', 1).try_cast("long")
    )
    number = F.col("number")
    hour = F.col("ts").cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour("ts"))
    return events.select(
        "event_id",
        hour.alias("event_time"),
        "event_type",
        (number % 20).alias("product_id"),
        (number % 6 + 100).alias("category_id"),
        _choice(number % 6, None, "a", "a.b", "a.b.c", "a.b.c.d", "a.b.c.d.e").alias("category_code"),
        _choice(number % 4, None, "north", "east", "south").alias("brand"),
        F.when(F.col("value") >= 1, F.col("value")).alias("price"),
        "user_id",
        F.when(F.col("user_id") % 25 != 0, (F.col("user_id") % 30).cast("string")).alias("user_session"),
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as events: an order is a session, the return flag the event type."""
    flag, status = F.lower("l_returnflag"), F.lower("l_linestatus")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("event_time"),
        F.when(flag == "n", "purchase").when(flag == "r", "cart").otherwise("view").alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        F.concat_ws(".", flag, status, F.col("l_linenumber").cast("string")).alias("category_code"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_suppkey").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("user_session"),
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = activity_raw(spark, sf_dir)
    return raw.transform(deduplicate, order_by=["event_id"]).transform(drop_incomplete)


def moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_purchase_movement(clean(spark, sf_dir))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as products with a category code of zero to five levels."""
    kind, name = F.lower("p_type"), F.col("p_name")
    parts = F.concat_ws(".", kind, F.replace(name, F.lit(" "), F.lit(".")))
    code = _choice(
        F.col("p_partkey") % 6,
        None,
        kind,
        F.concat_ws(".", kind, F.replace(name, F.lit(" "), F.lit("_"))),
        parts,
        F.concat(parts, F.lit(".x")),
        F.concat(parts, F.lit(".x.y")),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_size").cast("long").alias("category_id"),
        F.col("p_brand").alias("brand"),
        code.alias("category_code"),
    )


def rebranded_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole catalogue a month later: large products carry a new brand."""
    new_brand = F.when(F.col("category_id") > 25, F.concat("brand", F.lit("-new"))).otherwise(
        F.col("brand")
    )
    return catalogue(spark, sf_dir).withColumn("brand", new_brand)

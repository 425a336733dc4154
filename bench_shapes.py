"""Forms of this library against other forms of the same work: counts taken by extra
passes, two queries per profiled column, a window over all products.

Uses the settings of ``bench.py``; both forms read the same raw event files (Parquet
``lineitem`` shaped as events, stored as CSV once before timing). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bench import session
from tillroll import operators as op
from tillroll.operators.cleaning import report_of
from tillroll.plans import fixtures as fx
from tillroll.schemas import CRITICAL_COLUMNS, EVENT_KEY


def store(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def cleaning_one_pass(raw: DataFrame, path: str) -> tuple:
    staged = op.complete_rows(op.deduplicate(raw, copies="copies"))
    staged.write.mode("overwrite").partitionBy("is_complete").parquet(path)
    stored = raw.sparkSession.read.parquet(path)
    complete = F.col("is_complete").cast("boolean").cast("int").alias("complete")
    return tuple(report_of(stored.select("copies", complete)).first())


def cleaning_many_passes(raw: DataFrame, path: str) -> tuple:
    initial = raw.count()
    once = raw.dropDuplicates(EVENT_KEY)
    duplicates = initial - once.count()
    kept = once.dropna(subset=CRITICAL_COLUMNS)
    incomplete = once.count() - kept.count()
    final = kept.count()
    store(kept, path)
    return initial, duplicates, incomplete, final


def profile_one_query(raw: DataFrame, path: str) -> dict:
    return {row.column_name: row.unique_count for row in op.profile(raw).collect()}


def profile_query_per_column(raw: DataFrame, path: str) -> dict:
    counts = {}
    for name in raw.columns:
        counts[name] = raw.select(F.count_distinct(name)).first()[0]
        raw.select(name).distinct().limit(15 if counts[name] < 15 else 5).collect()
    return counts


def top_one_shuffle(activity: DataFrame, path: str) -> list:
    return [row.product_id for row in op.top_products(activity).collect()]


def top_window_over_all(activity: DataFrame, path: str) -> list:
    sales = op.purchases(activity).groupBy("product_id").agg(
        F.sum("price").alias("sales"), F.sum("purchase_movement").alias("movement")
    )
    share = F.col("sales") * 100 / F.sum("sales").over(Window.partitionBy())
    top = sales.withColumn("share", share).orderBy(F.desc("sales"), "product_id").limit(10)
    return [row.product_id for row in top.collect()]


def timed(work: Callable[[DataFrame, str], object], df: DataFrame, folder: str) -> tuple[float, object]:
    seconds, result = [], None
    for _ in range(4):
        path = f"{folder}/out-{uuid.uuid4().hex}"
        start = time.perf_counter()
        result = work(df, path)
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3), result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    shared = os.environ["BENCH_SHARED_DIR"]  # a folder that driver and executors share
    folder = f"{shared}/shapes-{uuid.uuid4().hex}"
    lines = fx.order_lines(spark, sf_dir)
    lines.write.option("header", True).csv(f"{folder}/csv")
    raw = spark.read.option("header", True).schema(lines.schema).csv(f"{folder}/csv")
    store(op.build_activity(op.clean_events(lines)), f"{folder}/activity")
    activity = spark.read.parquet(f"{folder}/activity")
    results = {}
    for name, ours, other, df in (
        ("cleaning", cleaning_one_pass, cleaning_many_passes, raw),
        ("profile", profile_one_query, profile_query_per_column, activity),
        ("top_products", top_one_shuffle, top_window_over_all, activity),
    ):
        fast, answer = timed(ours, df, folder)
        slow, expected = timed(other, df, folder)
        assert answer == expected, (name, answer, expected)
        results[name] = {"ours": fast, "other": slow, "speed_up": round(slow / fast, 2)}
    print(json.dumps(results))
    spark.stop()


if __name__ == "__main__":
    main()

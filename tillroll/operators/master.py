"""Product master: the set of all product rows ever seen."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.category import split_category
from tillroll.operators.guards import require_columns
from tillroll.schemas import MASTER_COLUMNS, MASTER_SCHEMA


def empty_master(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MASTER_SCHEMA)


def product_rows(df: DataFrame) -> DataFrame:
    """The distinct product rows of a batch, with levels derived if it lacks them."""
    if not set(MASTER_COLUMNS).issubset(df.columns):
        df = split_category(df)
    require_columns(df, MASTER_COLUMNS, "product_rows")
    return df.select(*MASTER_COLUMNS).distinct()


def union_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both, matched by column name; a column one side lacks becomes NULL."""
    return left.unionByName(right, allowMissingColumns=True)


def merge_master(history: DataFrame, batch: DataFrame) -> DataFrame:
    """History and batch as one set of rows, NULLs equal."""
    return union_by_name(history.select(*MASTER_COLUMNS), batch.select(*MASTER_COLUMNS)).distinct()


def new_master_rows(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Batch rows the history lacks: appending them equals :func:`merge_master`.

    A null-safe left-anti join on the whole row. Both sides are sets of rows, so no
    join key is hot, and the stored history is only read.
    """
    old = history.select(*MASTER_COLUMNS).alias("old")
    new = batch.select(*MASTER_COLUMNS).distinct().alias("new")
    same_row = reduce(and_, [new[name].eqNullSafe(old[name]) for name in MASTER_COLUMNS])
    return new.join(old, same_row, "left_anti")

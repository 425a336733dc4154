"""Column profile: distinct counts and listed values of every column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.schemas import LISTED_WHEN_FEW, LISTED_WHEN_MANY


# Nodes of a physical plan above which each column would pay the work below again.
REPEATED_WORK = ("Exchange", "Join", "Aggregate", "Window", "Python", "Arrow", "Pandas", "Generate", "csv", "json", "text")


def _computed(df: DataFrame) -> bool:
    """Is there more below than a columnar scan? One branch per column would repeat it."""
    names = df._jdf.queryExecution().sparkPlan().toString()
    formats = names.lower()
    return any(word in names for word in REPEATED_WORK[:8]) or any(f"filescan {w}" in formats for w in REPEATED_WORK[8:])


def _read_once(df: DataFrame) -> DataFrame:
    """``df``, stored in the session's checkpoint folder if it is computed and not stored yet."""
    if not _computed(df):
        return df
    if not df.sparkSession.conf.get("spark.checkpoint.dir", None):
        raise ValueError("profile a stored table, or set spark.checkpoint.dir to a shared folder")
    return df.checkpoint()


def _column(name: str) -> Column:
    return F.col("`{}`".format(name.replace("`", "``")))


def _distinct_values(df: DataFrame) -> DataFrame:
    """The distinct (column, value) pairs of ``df``, values as text.

    One aggregate per column, in the column's own type and in one query: each branch reads
    its own column of a columnar table. A map task sends each of its values at most once, so
    a frequent value is no hot key. Stacking the columns first would make every cell a text
    and was twice as slow.
    """
    return reduce(
        DataFrame.unionAll,
        [
            df.select(_column(name).alias("value"))
            .distinct()
            .select(F.lit(name).alias("column_name"), F.col("value").cast("string"))
            for name in df.columns
        ],
    )


def _counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("column_name").agg(F.count("value").alias("unique_count"))


def _estimates(df: DataFrame, error: float) -> DataFrame:
    """Estimated distinct counts of all columns in one pass; a column sends a sketch per task."""
    counted = df.agg(*[F.approx_count_distinct(_column(name), error).alias(f"c{k}") for k, name in enumerate(df.columns)])
    pairs = [F.struct(F.lit(name).alias("column_name"), F.col(f"c{k}").alias("unique_count")) for k, name in enumerate(df.columns)]
    return counted.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")


def unique_counts(df: DataFrame, approximate: bool = False, error: float = 0.02) -> DataFrame:
    """Number of distinct values per column, NULL not counted.

    Exact, or with ``approximate`` an estimate with this relative standard error, for columns
    of which nearly every value is different: an exact count shuffles all of these.
    """
    if approximate:
        return _estimates(df, error)
    return _counts(_distinct_values(_read_once(df)))


def sample_values(df: DataFrame) -> DataFrame:
    """Values of every column: all (and NULL) if it has few, else some.

    The values listed are the first in text order, NULL first. The rank filter is
    applied by every map task before the shuffle, so a column sends no more than its
    list from each.
    """
    return _listed(_read_once(df)).select("column_name", "position", "value")


def _listed(df: DataFrame, approximate: bool = False) -> DataFrame:
    pairs = _distinct_values(df)
    by_text = Window.partitionBy("column_name").orderBy(F.asc_nulls_first("value"))
    ranked = pairs.withColumn("position", F.row_number().over(by_text)).where(
        F.col("position") <= LISTED_WHEN_FEW
    )
    few = F.col("unique_count") < LISTED_WHEN_FEW
    # One row per column of the table, so this side is bounded by the schema.
    counts = F.broadcast(unique_counts(df, approximate=True) if approximate else _counts(pairs))
    return ranked.join(counts, "column_name").where(
        F.col("position") <= F.when(few, LISTED_WHEN_FEW).otherwise(LISTED_WHEN_MANY)
    )


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: its distinct count and its listed values in order.

    ``df`` should be a stored columnar table. A computed one, or CSV, is stored in the
    session's checkpoint folder first, so the work below it is done once and not once per
    column. ``approximate`` estimates the counts; which list a column with about as many
    values as the limit gets then depends on the estimate.
    """
    lists = _listed(_read_once(df), approximate).groupBy("column_name", "unique_count").agg(
        F.sort_array(F.collect_list(F.struct("position", "value"))).alias("listed")
    )
    return lists.select("column_name", "unique_count", F.col("listed.value").alias("listed_values"))


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows, for ``show()``."""
    return df.limit(rows)

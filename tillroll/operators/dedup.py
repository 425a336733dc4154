"""Duplicate removal on a key, with a fixed survivor."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.guards import require_columns
from tillroll.schemas import CRITICAL_COLUMNS, EVENT_KEY


def incomplete(columns: Sequence[str]) -> Column:
    """True where one of the columns is NULL."""
    return reduce(or_, [F.col(name).isNull() for name in columns])


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] = EVENT_KEY,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    order_by: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """One row per key; NULL keys equal each other.

    The survivor is the row without NULL in ``critical`` if the key has one, then
    the smallest by ``order_by``, then by the other columns, so it does not depend
    on how the input is split. It is the MIN of a struct, an aggregate with a
    map-side part: however many copies one key has, a map task sends one row for it.

    ``copies`` names an added column that counts the rows of the key.
    """
    require_columns(df, [*keys, *critical, *order_by], "deduplicate")
    leading = [name for name in order_by if name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in leading]
    survivor = F.min(F.struct(incomplete(critical).alias("_incomplete"), *leading, *rest))
    counts = [] if copies is None else [F.count(F.lit(1)).alias(copies)]
    kept = df.groupBy(*keys).agg(survivor.alias("_row"), *counts)
    values = [F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in df.columns]
    return kept.select(*values, *([] if copies is None else [copies]))

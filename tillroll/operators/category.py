"""Category code to hierarchy levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import category_level
from tillroll.operators.guards import require_columns
from tillroll.schemas import HIERARCHY_COLUMNS


def split_category(df: DataFrame, missing: str | None = None) -> DataFrame:
    """Add the four levels of ``category_code``; further parts are left out.

    ``missing`` fills a level the code lacks: ``""`` for the activity table, NULL
    for the product master.
    """
    require_columns(df, ["category_code"], "split_category")
    levels = {
        name: category_level(F.col("category_code"), number)
        for number, name in enumerate(HIERARCHY_COLUMNS, start=1)
    }
    split = df.withColumns(levels)
    return split if missing is None else split.fillna(dict.fromkeys(HIERARCHY_COLUMNS, missing))

from __future__ import annotations

import pytest

from tillroll.functions import table_name_for_file
from tillroll.operators import split_category
from tillroll.schemas import HIERARCHY_COLUMNS
from pyspark.sql import functions as F

CASES = {
    None: [None, None, None, None],
    "": ["", None, None, None],
    "a": ["a", None, None, None],
    "a.b.": ["a", "b", "", None],
    "a.b.c.d.e": ["a", "b", "c", "d"],
}


@pytest.mark.parametrize("missing", [None, ""])
def test_levels(spark, missing):
    df = spark.createDataFrame([(code,) for code in CASES], "category_code string")
    for row in split_category(df, missing).collect():
        expected = [missing if level is None else level for level in CASES[row.category_code]]
        assert [row[name] for name in HIERARCHY_COLUMNS] == expected


def test_other_nulls_are_not_filled(spark):
    df = spark.createDataFrame([(None, None)], "category_code string, brand string")
    row = split_category(df, "").first()
    assert row.brand is None and row.category_code is None


def test_no_category_code_raises(spark):
    with pytest.raises(ValueError, match="category_code"):
        split_category(spark.range(1))


@pytest.mark.parametrize(
    ("file_name", "table"),
    [
        ("2019-Oct.csv", "backup_2019_Oct"),
        ("a.b c.csv", "backup_a_b_c"),
        ("plain", "backup_plain"),
        (".csv", "backup__csv"),
        ("ü-1.csv", "backup___1"),
    ],
)
def test_backup_name(spark, file_name, table):
    df = spark.createDataFrame([(file_name,)], "name string")
    assert df.select(table_name_for_file(F.col("name"))).first()[0] == table

from __future__ import annotations

import pytest

from tillroll import operators as op


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(i, None if i == 0 else "ab"[i % 2], i % 14) for i in range(40)], "many long, few string, edge int")


def test_counts_leave_out_null(df):
    assert {r.column_name: r.unique_count for r in op.unique_counts(df).collect()} == {
        "many": 40, "few": 2, "edge": 14}


def test_few_values_are_all_listed(df):
    listed = {r.column_name: r.listed_values for r in op.profile(df).collect()}
    assert listed["few"] == [None, "a", "b"]
    assert len(listed["edge"]) == 14
    assert listed["many"] == ["0", "1", "10", "11", "12"]


def test_samples_match_profile(df):
    samples = {}
    for r in sorted(op.sample_values(df).collect(), key=lambda r: r.position):
        samples.setdefault(r.column_name, []).append(r.value)
    assert samples == {r.column_name: r.listed_values for r in op.profile(df).collect()}


def test_fourteen_values_and_null_fill_the_list(spark):
    df = spark.createDataFrame([(i,) for i in range(14)] + [(None,)], "n long")
    row = op.profile(df).first()
    assert row.unique_count == 14 and len(row.listed_values) == 15


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `c d` int")
    assert {r.column_name for r in op.unique_counts(df).collect()} == {"a.b", "c d"}


def test_preview(df):
    assert op.preview(df).count() == 10
    assert op.preview(df, 3).count() == 3


def test_estimates(spark, df):
    exact = {r.column_name: r.unique_count for r in op.unique_counts(df).collect()}
    near = {r.column_name: r.unique_count for r in op.unique_counts(df, approximate=True).collect()}
    assert exact.keys() == near.keys() and all(abs(near[c] - n) <= 0.1 * n for c, n in exact.items())
    assert op.profile(df, approximate=True).count() == 3


def test_work_below_is_done_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS b", "id % 5 AS c").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    computed = table.groupBy("b", "c").count()
    plan = op.profile(computed)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "ExistingRDD" in plan
    stored = op.profile(table)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in stored and "FileScan parquet" in stored
    assert {r.column_name: r.unique_count for r in op.profile(computed).collect()} == {"b": 3, "c": 5, "count": 2}


def test_wide_tables_are_profiled_whole(spark):
    wide = spark.range(3).selectExpr(*[f"id + {k} AS c{k}" for k in range(30)])
    assert op.profile(wide).count() == 30

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll import operators as op
from tillroll.schemas import MASTER_COLUMNS, MASTER_SCHEMA

BATCH = "product_id long, category_id long, category_code string, brand string, price double"
row = st.tuples(
    st.integers(1, 3), st.sampled_from([None, 7]), st.sampled_from([None, "", "a", "a.b"]),
    st.sampled_from([None, "x", "y"]), st.just(1.0),
)


def products(spark, rows):
    return op.product_rows(spark.createDataFrame(rows, BATCH))


def as_set(df):
    rows = [tuple(r[name] for name in MASTER_COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_same_row_once_new_brand_twice(spark):
    history = products(spark, [(1, 7, "a.b", "x", 1.0), (1, 7, "a.b", "x", 2.0)])
    assert history.count() == 1
    batch = products(spark, [(1, 7, "a.b", "x", 1.0), (1, 7, "a.b", "z", 1.0)])
    assert op.merge_master(history, batch).count() == 2
    assert [r.brand for r in op.new_master_rows(history, batch).collect()] == ["z"]


def test_levels_in_the_batch_are_kept(spark):
    blank = op.split_category(spark.createDataFrame([(1, 7, None, "x", 1.0)], BATCH), "")
    assert op.product_rows(blank).first().category_hierarchy_1 == ""


def test_nulls_are_equal(spark):
    rows = products(spark, [(1, None, None, None, 1.0)])
    assert op.new_master_rows(rows, rows).count() == 0
    assert op.merge_master(rows, rows).count() == 1


def test_empty_history(spark):
    batch = products(spark, [(1, 7, "a", "x", 1.0), (2, 7, None, "x", 1.0)])
    assert as_set(op.merge_master(op.empty_master(spark), batch)) == as_set(batch)
    assert op.empty_master(spark).schema == MASTER_SCHEMA


def test_missing_column_becomes_null(spark):
    left = spark.createDataFrame([(1, "x")], "product_id long, brand string")
    right = spark.createDataFrame([("c", 2)], "category_code string, product_id long")
    both = op.union_by_name(left, right)
    assert sorted(both.columns) == ["brand", "category_code", "product_id"]
    assert {(r.product_id, r.brand, r.category_code) for r in both.collect()} == {(1, "x", None), (2, None, "c")}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=st.lists(row, min_size=1, max_size=6), second=st.lists(row, min_size=1, max_size=6))
def test_merge_laws(spark, first, second):
    old, new = products(spark, first), products(spark, second)
    merged = as_set(op.merge_master(old, new))
    assert merged == as_set(old) | as_set(new)
    assert merged == as_set(op.merge_master(new, old))
    assert merged == as_set(old.unionByName(op.new_master_rows(old, new)))


def test_missing_product_column_raises(spark):
    with pytest.raises(ValueError, match="brand"):
        op.product_rows(spark.createDataFrame([(1, 7, "a")], "product_id long, category_id long, category_code string"))

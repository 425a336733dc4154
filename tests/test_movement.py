from __future__ import annotations

import random
from collections import defaultdict

import pytest

from tests import mini
from tillroll import operators as op
from tillroll.schemas import HIERARCHY_COLUMNS


@pytest.fixture
def skewed(spark):
    """A third of all rows in one (product, session), some groups with NULL."""
    chance = random.Random(5)
    rows = [(mini.time(second * 97 % 86_400, 1 + second % 3), "view", 1, 1.0, 1, "hot") for second in range(300)]
    rows += [
        (mini.time(chance.randrange(86_400), chance.randrange(1, 4)), "cart", chance.choice([1, 2, 3, None]),
         1.0, 1, chance.choice(["a", "b", None]))
        for _ in range(600)
    ]
    return mini.events(spark, rows).dropDuplicates(["event_time", "product_id", "user_session"]).cache()


def numbers(df):
    return {(r.product_id, r.user_session, r.event_time): r.purchase_movement for r in df.collect()}


def test_equals_brute_force(skewed):
    groups = defaultdict(list)
    for row in skewed.collect():
        groups[row.product_id, row.user_session].append(row.event_time)
    expected = {
        (*group, time): number
        for group, times in groups.items()
        for number, time in enumerate(sorted(times), start=1)
    }
    assert numbers(op.add_purchase_movement(skewed)) == expected
    assert numbers(op.add_purchase_movement_sliced(skewed, "hour")) == expected
    assert numbers(op.add_purchase_movement_sliced(skewed, "day")) == expected


def test_sliced_splits_the_hot_group(spark, skewed):
    """No task sorts the hot group as a whole."""
    plan = op.add_purchase_movement_sliced(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number() windowspecdefinition(_slice" in plan


def test_both_forms_give_the_same_schema(skewed):
    plain, sliced = op.add_purchase_movement(skewed), op.add_purchase_movement_sliced(skewed)
    assert plain.dtypes == sliced.dtypes
    assert dict(plain.dtypes)["purchase_movement"] == "int"


def test_slice_width_is_checked(skewed):
    with pytest.raises(ValueError, match="width"):
        op.add_purchase_movement_sliced(skewed, "week")


def test_text_time_is_parsed(spark):
    df = spark.createDataFrame(
        [("2019-10-01 10:00:00", 1, "s"), ("2019-10-01 09:00:00", 1, "s")],
        "event_time string, product_id long, user_session string",
    )
    assert {r.event_time.hour: r.purchase_movement for r in op.add_purchase_movement(df).collect()} == {9: 1, 10: 2}


def test_missing_column_raises(skewed):
    with pytest.raises(ValueError, match="product_id"):
        op.add_purchase_movement(skewed.drop("product_id"))


@pytest.mark.parametrize("width", [None, "day", "hour"])
def test_activity_has_blank_levels_and_number(skewed, width):
    activity = op.build_activity(skewed, width)
    assert activity.where("category_hierarchy_1 IS NULL OR purchase_movement IS NULL").count() == 0
    assert set(activity.columns) == {*skewed.columns, *HIERARCHY_COLUMNS, "purchase_movement"}

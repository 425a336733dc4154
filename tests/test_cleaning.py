from __future__ import annotations

import datetime as dt
import random

import pytest

from tests import mini
from tillroll import operators as op
from tillroll.schemas import CRITICAL_COLUMNS, EVENT_KEY
from tillroll.sources import read_events


@pytest.fixture
def raw(spark, tmp_path):
    return read_events(spark, mini.write(tmp_path, "2019-Oct.csv", mini.HEADER + mini.LINES))


def test_mini_file_counts(raw):
    assert raw.count() == 6
    once = op.deduplicate(raw)
    assert once.count() == 4
    assert op.drop_incomplete(once).count() == 2
    assert op.cleaning_report(raw).first().asDict() == {
        "initial_rows": 6,
        "duplicate_rows": 2,
        "incomplete_rows": 2,
        "final_rows": 2,
    }


def test_survivor_is_the_smallest_other_row(raw):
    kept = op.deduplicate(raw).where("product_id = 5773353").collect()
    assert [row.event_type for row in kept] == ["cart"]


def test_complete_row_survives_an_incomplete_copy(spark):
    rows = [(mini.time(1), "view", 1, 1.0, None, "s"), (mini.time(1), "view", 1, 1.0, 5, "s")]
    assert [row.user_id for row in op.deduplicate(mini.events(spark, rows)).collect()] == [5]
    assert op.clean_events(mini.events(spark, rows)).count() == 1


def test_null_keys_are_one_key(spark):
    rows = [(None, "view", None, 1.0, 1, None)] * 3 + [(None, "view", None, 1.0, 1, "s")]
    assert op.deduplicate(mini.events(spark, rows)).count() == 2


def test_column_order_and_types_stay(raw):
    once = op.deduplicate(raw)
    assert once.columns == raw.columns
    assert [f.dataType for f in once.schema] == [f.dataType for f in raw.schema]


def test_result_does_not_depend_on_the_partitions(spark):
    chance = random.Random(3)
    rows = [
        (mini.time(chance.randrange(5)), chance.choice(["view", "cart"]), chance.choice([1, 2, None]),
         chance.choice([1.0, 2.5, None]), chance.choice([1, 2, None]), chance.choice(["s", "t", None]))
        for _ in range(400)
    ]
    df = mini.events(spark, rows)
    few, many = (sorted(map(str, op.clean_events(df.repartition(n)).collect())) for n in (1, 7))
    assert few == many

    # Brute force: one row per key, complete if any copy is, smallest otherwise.
    keys = {(t, session, product) for t, _, product, _, _, session in rows}
    complete = {(t, s, p) for t, kind, p, _, user, s in rows if None not in (t, kind, p, user, s)}
    report = op.cleaning_report(df).first()
    assert tuple(report) == (400, 400 - len(keys), len(keys) - len(complete), len(complete))
    assert len(few) == len(complete)


def test_copies_are_counted(raw):
    counted = {tuple(row[key] for key in EVENT_KEY): row.n for row in op.deduplicate(raw, copies="n").collect()}
    assert sorted(counted.values()) == [1, 1, 2, 2]


def test_report_of_no_rows(spark):
    assert tuple(op.cleaning_report(mini.events(spark, [])).first()) == (0, 0, 0, 0)


def test_load_date_replaces_one_in_the_input(raw):
    stamped = op.stamp_processed_date(op.stamp_processed_date(raw), dt.date(2020, 1, 2))
    assert {row.processed_date for row in stamped.collect()} == {dt.date(2020, 1, 2)}
    assert dict(stamped.dtypes)["processed_date"] == "date"


def test_load_date_is_today_unless_given(raw):
    row = op.stamp_processed_date(raw).selectExpr("processed_date = current_date() AS today").distinct().collect()
    assert [r.today for r in row] == [True]


def test_bad_time_becomes_null(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:00 UTC",), ("soon",), (None,)], "event_time string")
    assert [row.event_time for row in op.cast_event_time(df).collect()] == [mini.time(0), None, None]


def test_missing_columns_are_named(raw):
    with pytest.raises(ValueError, match="user_session"):
        op.deduplicate(raw.drop("user_session"))
    with pytest.raises(ValueError, match="event_type"):
        op.drop_incomplete(raw.drop("event_type"), CRITICAL_COLUMNS)

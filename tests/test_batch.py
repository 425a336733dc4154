from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest

from tests import mini
from tillroll import operators as op
from tillroll.plans import batch as batch_module
from tillroll.plans.backup import backup_csv
from tillroll.plans.batch import BatchConfig, run_batch
from tillroll.schemas import HIERARCHY_COLUMNS, MASTER_COLUMNS
from tillroll.sources import archive_files, drop_table, read_events, with_source_file

DATE = dt.date(2020, 3, 1)


@pytest.fixture
def config(spark, tmp_path):
    made = BatchConfig(
        new_files=str(tmp_path / "new"),
        archive=str(tmp_path / "done"),
        batch_date=DATE,
    )
    yield made
    for name in (made.activity_table, made.master_table, made.record_table):
        drop_table(spark, name)
    for table in spark.catalog.listTables():
        if table.name.startswith("backup_"):
            drop_table(spark, table.name)


def content(spark, config):
    return tuple(
        sorted(map(str, spark.table(name).collect())) for name in (config.activity_table, config.master_table)
    )


def test_two_months(spark, config, tmp_path):
    mini.write(tmp_path / "new", "2019-Oct.csv", mini.HEADER + mini.LINES)
    first = run_batch(spark, config, "2019-10")
    assert first.report == {"initial_rows": 6, "duplicate_rows": 2, "incomplete_rows": 2, "final_rows": 2}
    assert [path.rsplit("/", 1)[1] for path in first.archived] == ["2019-Oct.csv"]
    assert list((tmp_path / "new").glob("*.csv")) == []
    assert not spark.catalog.tableExists(config.staging_of("2019-10"))

    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    run_batch(spark, config, "2019-11")
    activity = spark.table(config.activity_table)
    assert {(r.batch_id, r["count"]) for r in activity.groupBy("batch_id").count().collect()} == {
        ("2019-10", 2), ("2019-11", 3)}
    assert {"event_type", *HIERARCHY_COLUMNS, "purchase_movement", "processed_date"} <= set(activity.columns)
    # The history outlives the second batch, and the renamed product has two rows.
    master = spark.table(config.master_table)
    assert master.columns == MASTER_COLUMNS
    assert {(r.product_id, r.brand) for r in master.collect()} == {
        (5773203, "runail"), (5773353, "runail"), (5773353, "renamed")}
    assert master.where("category_hierarchy_2 IS NOT NULL AND category_hierarchy_2 <> 'glove'").count() == 0

    top = op.top_products(activity).collect()
    assert [(r.product_id, r.total_sales) for r in top] == [(5773353, 6.0), (5773203, 2.62)]
    assert op.daily_sales(activity, "2019-10-01", "2019-11-30").count() == 2


def test_running_a_batch_again_changes_nothing(spark, config, tmp_path):
    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    run_batch(spark, config, "2019-11")
    once = content(spark, config)
    (tmp_path / "done" / "2019-Nov.csv").rename(tmp_path / "new" / "2019-Nov.csv")
    run_batch(spark, config, "2019-11")
    assert content(spark, config) == once


def test_failure_leaves_the_files(spark, config, tmp_path, monkeypatch):
    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    with monkeypatch.context() as broken:
        broken.setattr(batch_module, "update_master", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_batch(spark, config, "2019-11")
    assert (tmp_path / "new" / "2019-Nov.csv").exists()
    run_batch(spark, config, "2019-11")
    assert spark.table(config.activity_table).count() == 3
    assert spark.table(config.master_table).count() == 2


def test_all_files_of_a_batch_are_loaded(spark, config, tmp_path):
    mini.write(tmp_path / "new", "2019-Oct.csv", mini.HEADER + mini.LINES)
    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    mini.write(tmp_path / "new", "odd.csv", "a,b\n1,2\n")
    result = run_batch(spark, config, "both")
    assert result.report["final_rows"] == 5
    assert [file.path.rsplit("/", 1)[1] for file in result.skipped] == ["odd.csv"]
    assert (tmp_path / "new" / "odd.csv").exists()
    assert result.backup.tables == ["backup_2019_Nov", "backup_2019_Oct"]


def test_no_file_raises(spark, config, tmp_path):
    (tmp_path / "new").mkdir()
    with pytest.raises(FileNotFoundError):
        run_batch(spark, config, "none")


@pytest.mark.parametrize("width", ["day", "hour"])
def test_slices_give_the_same_tables(spark, config, tmp_path, width):
    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    run_batch(spark, config, "2019-11")
    whole = content(spark, config)
    for name in (config.activity_table, config.master_table):
        drop_table(spark, name)
    (tmp_path / "done" / "2019-Nov.csv").rename(tmp_path / "new" / "2019-Nov.csv")
    run_batch(spark, replace(config, slice_width=width), "2019-11")
    assert content(spark, config) == whole
    rows = spark.table(config.activity_table).where("product_id = 5773353").orderBy("event_time").collect()
    assert [row.purchase_movement for row in rows] == [1, 2]


def line(second, product, session="s1"):
    return f"2019-11-03 00:00:{second:02d} UTC,purchase,{product},7,,b,1.00,1,{session}\n"


def products(spark, config):
    return sorted(r.product_id for r in spark.table(config.activity_table).collect())


def test_archive_that_fails_loses_no_rows(spark, config, tmp_path):
    for n in (1, 2, 3):
        mini.write(tmp_path / "new", f"f{n}.csv", mini.HEADER + line(n, n))
    mini.write(tmp_path / "done", "f2.csv", "taken")
    with pytest.raises(FileExistsError):
        run_batch(spark, config, "b")
    assert len(list((tmp_path / "new").glob("*.csv"))) == 3 and products(spark, config) == [1, 2, 3]
    (tmp_path / "done" / "f2.csv").rename(tmp_path / "done" / "other")
    run_batch(spark, config, "b")
    assert products(spark, config) == [1, 2, 3]
    assert list((tmp_path / "new").glob("*.csv")) == []


def test_move_that_fails_half_way_loses_no_rows(spark, config, tmp_path, monkeypatch):
    for n in (1, 2, 3):
        mini.write(tmp_path / "new", f"f{n}.csv", mini.HEADER + line(n, n))

    def first_only(session, paths, folder, at_once):
        archive_files(session, paths[:1], folder)
        raise OSError("gone away")

    with monkeypatch.context() as broken:
        broken.setattr(batch_module, "archive_files", first_only)
        with pytest.raises(OSError):
            run_batch(spark, config, "b")
    assert len(list((tmp_path / "new").glob("*.csv"))) == 2
    run_batch(spark, config, "b")
    assert products(spark, config) == [1, 2, 3] and list((tmp_path / "new").glob("*.csv")) == []


def test_late_and_repaired_files_of_a_batch_are_added(spark, config, tmp_path):
    mini.write(tmp_path / "new", "good.csv", mini.HEADER + line(1, 1))
    mini.write(tmp_path / "new", "late.csv", "x,y\n1,2\n")
    assert len(run_batch(spark, config, "b").skipped) == 1
    mini.write(tmp_path / "new", "late.csv", mini.HEADER + line(2, 2) + line(3, 3))
    run_batch(spark, config, "b")
    assert products(spark, config) == [1, 2, 3]
    # The same file once more with other rows on other days replaces its own rows only.
    (tmp_path / "done" / "late.csv").rename(tmp_path / "done" / "old")
    mini.write(tmp_path / "new", "late.csv", mini.HEADER + line(4, 4).replace("11-03", "11-04"))
    run_batch(spark, config, "b")
    assert products(spark, config) == [1, 4]


def test_two_batches_do_not_share_a_staging_table(spark, config, tmp_path):
    mini.write(tmp_path / "new", "f1.csv", mini.HEADER + line(1, 1))
    for batch_id, product in (("a b", 1), ("a_b", 2)):
        path = mini.write(tmp_path / "other", f"{product}.csv", mini.HEADER + line(1, product))
        events = with_source_file(read_events(spark, path))
        batch_module.stage_events(events, config, batch_id)
    for batch_id, product in (("a b", 1), ("a_b", 2)):
        batch_module.load_activity(spark, config, batch_id, [f"{product}.csv"])
        drop_table(spark, config.staging_of(batch_id))
    assert {(r.batch_id, r.product_id) for r in spark.table(config.activity_table).collect()} == {("a b", 1), ("a_b", 2)}


def test_file_without_backup_is_neither_loaded_nor_moved(spark, config, tmp_path):
    elsewhere = mini.write(tmp_path / "elsewhere", "f1.csv", mini.HEADER + line(1, 9))
    backup_csv(spark, [elsewhere], DATE)
    mini.write(tmp_path / "new", "f1.csv", mini.HEADER + line(1, 1))
    mini.write(tmp_path / "new", "f2.csv", mini.HEADER + line(2, 2))
    result = run_batch(spark, config, "b")
    assert [f.path.rsplit("/", 1)[1] for f in result.backup.failed] == ["f1.csv"]
    assert products(spark, config) == [2]
    assert (tmp_path / "new" / "f1.csv").exists() and not (tmp_path / "new" / "f2.csv").exists()
    assert spark.table("backup_f1").first().product_id == 9


def test_day_filter_reads_only_its_partitions(spark, config, tmp_path):
    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    run_batch(spark, config, "2019-11")
    one_day = op.in_time_range(spark.table(config.activity_table), "2019-11-01", "2019-11-01 23:59:59")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert len(one_day.inputFiles()) >= 1 and one_day.count() == 2


def test_backup_is_a_table_per_file(spark, tmp_path):
    oct_file = mini.write(tmp_path / "new", "2019-Oct.csv", mini.HEADER + mini.LINES)
    nov_file = mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    assert backup_csv(spark, [oct_file], DATE).tables == ["backup_2019_Oct"]
    backup_csv(spark, [nov_file], DATE)
    assert spark.table("backup_2019_Oct").count() == 6
    assert spark.table("backup_2019_Nov").columns == [*mini.HEADER.strip().split(","), "processed_date"]
    # Types are those of each file: one has a product that is no number.
    assert dict(spark.table("backup_2019_Oct").dtypes)["product_id"] == "string"
    assert dict(spark.table("backup_2019_Nov").dtypes)["product_id"] == "int"
    mini.write(tmp_path / "new", "2019-Oct.csv", mini.HEADER + mini.LINES.split("\n")[0] + "\n")
    backup_csv(spark, [oct_file], DATE)
    assert spark.table("backup_2019_Oct").count() == 1
    assert spark.table("backup_2019_Nov").count() == 3
    for name in ("backup_2019_Oct", "backup_2019_Nov"):
        drop_table(spark, name)


def test_a_file_that_cannot_be_read_does_not_stop_the_others(spark, tmp_path):
    good = mini.write(tmp_path, "good.csv", mini.HEADER + mini.LINES)
    result = backup_csv(spark, [str(tmp_path / "gone.csv"), good], DATE)
    assert result.tables == ["backup_good"]
    assert [file.path for file in result.failed] == [str(tmp_path / "gone.csv")]
    drop_table(spark, "backup_good")


def test_backup_in_a_database(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    path = mini.write(tmp_path, "m.csv", mini.HEADER + mini.LINES)
    assert backup_csv(spark, [path], DATE, database="raw").tables == ["raw.backup_m"]
    assert spark.table("raw.backup_m").count() == 6
    spark.sql("DROP DATABASE raw CASCADE")


def test_backup_name_clash_raises(spark, tmp_path):
    paths = [mini.write(tmp_path, name, mini.HEADER) for name in ("2019-Oct.csv", "2019_Oct.csv")]
    with pytest.raises(ValueError, match="backup_2019_Oct"):
        backup_csv(spark, paths)
    cases = [mini.write(tmp_path / folder, name, mini.HEADER) for folder, name in (("a", "m-Oct.csv"), ("b", "m-oct.csv"))]
    with pytest.raises(ValueError, match="would both be"):
        backup_csv(spark, cases)

from __future__ import annotations

import pytest

from tests import mini
from tillroll.jobs import main
from tillroll.sources import drop_table

TABLES = {"--activity-table": "job_activity", "--master-table": "job_master", "--record-table": "job_files"}


@pytest.fixture
def run(spark, tmp_path):
    fixed = [part for pair in TABLES.items() for part in pair]
    folders = ["--new-files", str(tmp_path / "new"), "--archive", str(tmp_path / "done")]
    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    yield lambda job, *more: main([job, *folders, *fixed, *more], spark)
    for name in (*TABLES.values(), "backup_2019_Nov"):
        drop_table(spark, name)


def stored(spark):
    return [sorted(map(str, spark.table(name).collect())) for name in ("job_activity", "job_master", "backup_2019_Nov")]


def test_single_steps_equal_the_whole_batch(spark, tmp_path, run, capsys):
    for job in ("backup", "stage", "activity", "master", "drop", "archive"):
        run(job, "--batch-id", "2019-11")
    steps = stored(spark)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("staged_events_2019_11")]
    (tmp_path / "done" / "2019-Nov.csv").rename(tmp_path / "new" / "2019-Nov.csv")
    run("batch", "--batch-id", "2019-11")
    assert stored(spark) == steps
    for job, wanted in (("profile", 18), ("daily-sales", 2), ("top-products", 2)):
        run(job, "--output", str(tmp_path / job))
        run(job, "--output", "job_report")
        assert spark.table("job_report").count() == spark.read.parquet(str(tmp_path / job)).count() == wanted
    drop_table(spark, "job_report")


def test_a_file_dropped_between_the_steps_waits_for_the_next_batch(spark, tmp_path, run):
    run("backup", "--batch-id", "b")
    run("stage", "--batch-id", "b")
    mini.write(tmp_path / "new", "2019-Oct.csv", mini.HEADER + mini.LINES)
    for job in ("activity", "master", "drop", "archive"):
        run(job, "--batch-id", "b")
    assert [p.name for p in (tmp_path / "new").glob("*.csv")] == ["2019-Oct.csv"]
    assert [p.name for p in (tmp_path / "done").glob("*.csv")] == ["2019-Nov.csv"]
    assert spark.table("job_activity").count() == 3
    drop_table(spark, "backup_2019_Oct")
    run("batch", "--batch-id", "b")
    assert spark.table("job_activity").count() == 5
    drop_table(spark, "backup_2019_Oct")


def test_reports_are_stored_whole(spark, tmp_path, run):
    days = spark.range(1500).selectExpr(
        "timestamp'2015-01-01' + make_dt_interval(cast(id as int)) event_time", "'purchase' event_type", "id product_id", "1.0D price", "1 purchase_movement")
    days.write.mode("overwrite").saveAsTable("job_activity")
    run("daily-sales", "--start", "2015-01-01", "--end", "2020-12-31", "--output", str(tmp_path / "days"))
    assert spark.read.parquet(str(tmp_path / "days")).count() == 1500


def test_batch_date_is_an_option(spark, tmp_path, run):
    run("batch", "--batch-id", "b", "--batch-date", "2021-02-03")
    assert {str(r.processed_date) for r in spark.table("job_activity").collect()} == {"2021-02-03"}


def test_batch_needs_a_name(run):
    with pytest.raises(SystemExit):
        run("batch")


def test_no_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        main(["stage", "--new-files", str(tmp_path), "--batch-id", "none", "--record-table", "job_files"], spark)
    drop_table(spark, "job_files")

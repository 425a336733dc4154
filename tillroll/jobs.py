"""The steps of a batch as jobs of their own, for ``spark-submit`` or a scheduler.

``run_job.py batch --new-files … --archive … --batch-id 2019-10`` does all of them in
order. Steps submitted one by one hand their tables on through the session's catalog, and
work on the files that the batch has recorded. Reports are stored whole in the table or
path that ``--output`` names; what is printed is a preview.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tillroll import operators as op
from tillroll.plans.batch import (
    BatchConfig,
    archive_batch,
    back_up,
    events_of,
    load_activity,
    record_of,
    run_batch,
    stage_events,
    update_master,
)
from tillroll.plans.panels import run_panel
from tillroll.plans.record import LOADED, TAKEN, BatchRecord, RecordedFile
from tillroll.schemas import ACTIVITY_TABLE, DASHBOARD_FROM, DASHBOARD_TO, MASTER_TABLE
from tillroll.sources import drop_table, replace_table
from tillroll.streaming import start_ingest

Job = Callable[[SparkSession, BatchConfig, argparse.Namespace], None]


def _taken(spark: SparkSession, config: BatchConfig, batch_id: str) -> tuple[BatchRecord, list[RecordedFile]]:
    record = record_of(spark, config, batch_id)
    files, skipped = record.take(config.new_files)
    for file in skipped:
        print(f"skipped {file.path}: {file.reason}")
    if not files:
        raise FileNotFoundError(f"no usable CSV file in {config.new_files}")
    return record, files


def _backup(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    print(back_up(spark, config, *_taken(spark, config, options.batch_id))[0])


def _stage(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    _, files = _taken(spark, config, options.batch_id)
    fresh = [file for file in files if file.state == TAKEN]
    if fresh:
        stage_events(events_of(spark, fresh), config, options.batch_id).show()


def _activity(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    names = [file.name for file in record_of(spark, config, options.batch_id).open_files() if file.state == TAKEN]
    load_activity(spark, config, options.batch_id, names)
    op.preview(spark.table(config.activity_table)).show()


def _drop(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    """The batch's last step on its data: its files are loaded."""
    drop_table(spark, config.staging_of(options.batch_id))
    record = record_of(spark, config, options.batch_id)
    record.write([file for file in record.open_files() if file.state == TAKEN], LOADED)


def _archive(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    print(archive_batch(spark, config, record_of(spark, config, options.batch_id)))


def _ingest(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    start_ingest(spark, config, options.feed).awaitTermination()


def _report(df: DataFrame, options: argparse.Namespace) -> None:
    """Store a report whole, in a table or, if the name has a slash, a path; show its first rows."""
    spark, output = df.sparkSession, options.output
    if "/" in output:
        df.write.mode("overwrite").parquet(output)
        stored = spark.read.parquet(output)
    else:
        replace_table(df, output)
        stored = spark.table(output)
    print(f"{output}, the first rows:")
    op.preview(stored).show(truncate=False)


def _profile(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    _report(op.profile(spark.table(config.activity_table), approximate=options.approximate), options)


def _daily_sales(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    _report(op.daily_sales(spark.table(config.activity_table), options.start, options.end), options)


def _top_products(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    _report(op.top_products(spark.table(config.activity_table)), options)


def _panel(spark: SparkSession, config: BatchConfig, options: argparse.Namespace) -> None:
    """A dashboard's own query, from a file anywhere that Spark reads."""
    sql = spark.read.text(options.sql_file, wholetext=True).first()[0]
    _report(run_panel(spark, sql, options.start, options.end, options.day_column), options)


JOBS: dict[str, Job] = {
    "backup": _backup,
    "stage": _stage,
    "activity": _activity,
    "master": lambda spark, config, options: update_master(spark, config, options.batch_id),
    "drop": _drop,
    "archive": _archive,
    "batch": lambda spark, config, options: print(run_batch(spark, config, options.batch_id)),
    "ingest": _ingest,
    "profile": _profile,
    "daily-sales": _daily_sales,
    "top-products": _top_products,
    "panel": _panel,
}
NEED_BATCH = {"backup", "stage", "activity", "master", "drop", "archive", "batch"}
NEED_OUTPUT = {"profile", "daily-sales", "top-products", "panel"}


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--new-files", default="new")
    parser.add_argument("--archive", default="archive")
    parser.add_argument("--batch-id", help="name of the batch, e.g. its month")
    parser.add_argument("--batch-date", type=dt.date.fromisoformat, help="load date, for a re-run on another day")
    parser.add_argument("--feed", default="feed", help="name of the incremental load")
    parser.add_argument("--staging-table", default="staged_events")
    parser.add_argument("--activity-table", default=ACTIVITY_TABLE)
    parser.add_argument("--master-table", default=MASTER_TABLE)
    parser.add_argument("--record-table", default="batch_files")
    parser.add_argument("--backup-database")
    parser.add_argument("--slice-width", choices=op.SLICE_WIDTHS, help="number sessions in slices of time")
    parser.add_argument("--output", help="table, or path with a slash, that a report is stored in")
    parser.add_argument("--approximate", action="store_true", help="estimate distinct counts of the profile")
    parser.add_argument("--sql-file", help="the query of a panel")
    parser.add_argument("--day-column", help="date column that the panel's table is stored by")
    # The range of the sales dashboard, where none is asked for.
    parser.add_argument("--start", default=DASHBOARD_FROM)
    parser.add_argument("--end", default=DASHBOARD_TO, help="a date alone is a whole day")
    options = parser.parse_args(arguments)
    if options.job in NEED_BATCH and not options.batch_id:
        parser.error(f"{options.job} needs --batch-id")
    if options.job in NEED_OUTPUT and not options.output:
        parser.error(f"{options.job} needs --output")
    if options.job == "panel" and not options.sql_file:
        parser.error("panel needs --sql-file")
    config = BatchConfig(
        new_files=options.new_files,
        archive=options.archive,
        staging_table=options.staging_table,
        activity_table=options.activity_table,
        master_table=options.master_table,
        record_table=options.record_table,
        backup_database=options.backup_database,
        batch_date=options.batch_date,
        slice_width=options.slice_width,
    )
    JOBS[options.job](spark or SparkSession.builder.getOrCreate(), config, options)

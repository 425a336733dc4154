"""One batch of month files from the folder they are dropped in to the stored tables."""

from __future__ import annotations

import datetime as dt
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions import day_of
from tillroll.operators import (
    build_activity,
    complete_rows,
    deduplicate,
    new_master_rows,
    product_rows,
    stamp_processed_date,
)
from tillroll.operators.cleaning import report_of
from tillroll.plans.backup import BackupResult, backup_csv
from tillroll.plans.record import ARCHIVED, LOADED, REFUSED, TAKEN, BatchRecord, RecordedFile
from tillroll.schemas import ACTIVITY_TABLE, MASTER_SCHEMA, MASTER_TABLE
from tillroll.sources import (
    SOURCE_FILE,
    SkippedFile,
    append_rows,
    archive_files,
    create_table_if_missing,
    drop_table,
    read_events,
    replace_partitions,
    replace_table,
    with_source_file,
)

BATCH_KEY, DAY = "batch_id", "event_date"


@dataclass(frozen=True)
class BatchConfig:
    """Folders, table names and settings of a pipeline. All folders are on shared storage.

    ``slice_width`` (``None``, ``"day"`` or ``"hour"``) is how the events of a product in a
    session are numbered: whole in one task, or in slices of time spread over tasks. The
    numbers are the same. Whole is faster, and a group has at most one row per distinct time,
    so whole seconds bound it (2.7 million in a month); ask for slices where times have
    fractions and one session may hold a large part of all rows.
    """

    new_files: str
    archive: str
    staging_table: str = "staged_events"
    activity_table: str = ACTIVITY_TABLE
    master_table: str = MASTER_TABLE
    record_table: str = "batch_files"
    backup_database: str | None = None
    batch_date: dt.date | None = None
    slice_width: str | None = None
    backups_at_once: int = 4
    moves_at_once: int = 16

    def staging_of(self, batch_id: str) -> str:
        """A staging table for each batch, so that two of them don't meet."""
        safe = re.sub("[^a-z0-9_]", "_", batch_id.lower())
        return f"{self.staging_table}_{safe}_{zlib.crc32(batch_id.encode()):08x}"


@dataclass(frozen=True)
class BatchResult:
    batch_id: str
    report: dict[str, int]
    backup: BackupResult = field(default_factory=BackupResult)
    skipped: list[SkippedFile] = field(default_factory=list)
    archived: list[str] = field(default_factory=list)


def record_of(spark: SparkSession, config: BatchConfig, batch_id: str) -> BatchRecord:
    return BatchRecord(spark, config.record_table, batch_id)


def stage_events(events: DataFrame, config: BatchConfig, batch_id: str) -> DataFrame:
    """Write the duplicate-free events to the batch's staging table and return its report.

    The input is read once. Incomplete rows are kept apart in a partition of their own
    and each row knows how many copies it stands for, so the report is read from the
    stored table, whatever had to be run twice while writing it.
    """
    staged = (
        deduplicate(events, copies="copies")
        .transform(stamp_processed_date, config.batch_date)
        .transform(complete_rows)
    )
    table = config.staging_of(batch_id)
    replace_table(staged, table, partition_by=["is_complete"])
    stored = events.sparkSession.table(table)
    return report_of(stored.select("copies", F.col("is_complete").cast("int").alias("complete")))


def staged_events(spark: SparkSession, config: BatchConfig, batch_id: str) -> DataFrame:
    """The complete rows of the staging table; the others are not read."""
    table = spark.table(config.staging_of(batch_id))
    return table.where("is_complete").drop("is_complete", "copies")


def load_activity(spark: SparkSession, config: BatchConfig, batch_id: str, names: Sequence[str]) -> None:
    """Add the staged events of the files ``names`` to the activity table.

    Rows that the batch already has from these files are replaced; those of other files
    stay. Duplicate removal and numbering cover the files that are loaded together.
    """
    staged = staged_events(spark, config, batch_id)
    activity = build_activity(staged, config.slice_width)
    by_day = activity.withColumn(BATCH_KEY, F.lit(batch_id)).withColumn(DAY, day_of(F.col("event_time")))
    layout = [T.StructField(name, T.StringType()) for name in (BATCH_KEY, SOURCE_FILE)]
    layout.append(T.StructField(DAY, T.DateType()))
    partitions = [f.name for f in layout]
    schema = T.StructType([*(f for f in activity.schema if f.name not in partitions), *layout])
    create_table_if_missing(spark, config.activity_table, schema, partitions)
    # Well-sized files per day; a day with many rows is split over several tasks.
    rows = by_day.hint("rebalance", SOURCE_FILE, DAY)
    replace_partitions(rows, config.activity_table, [BATCH_KEY, SOURCE_FILE], [(batch_id, n) for n in names])


def update_master(spark: SparkSession, config: BatchConfig, batch_id: str) -> None:
    """Append the product rows the master does not have yet."""
    create_table_if_missing(spark, config.master_table, MASTER_SCHEMA)
    batch = product_rows(staged_events(spark, config, batch_id))
    new_rows = new_master_rows(spark.table(config.master_table), batch)
    append_rows(new_rows.hint("rebalance"), config.master_table)


def load_events(events: DataFrame, config: BatchConfig, batch_id: str, names: Sequence[str]) -> BatchResult:
    """Raw events with their ``source_file`` to activity and master tables.

    ``names`` are the files that the events come from. Repeating it changes nothing.
    """
    spark = events.sparkSession
    report = stage_events(events, config, batch_id).first()
    load_activity(spark, config, batch_id, names)
    update_master(spark, config, batch_id)
    drop_table(spark, config.staging_of(batch_id))
    return BatchResult(batch_id, report.asDict())


def events_of(spark: SparkSession, files: Sequence[RecordedFile]) -> DataFrame:
    return with_source_file(read_events(spark, [file.path for file in files]))


def back_up(
    spark: SparkSession, config: BatchConfig, record: BatchRecord, files: Sequence[RecordedFile]
) -> tuple[BackupResult, list[RecordedFile]]:
    """Copy the files raw; those that fail are refused: not loaded and not moved."""
    fresh = [file for file in files if file.state == TAKEN]
    paths = [file.path for file in fresh]
    result = backup_csv(spark, paths, config.batch_date, config.backup_database, config.backups_at_once)
    failed = {file.path for file in result.failed}
    record.write([file for file in fresh if file.path in failed], REFUSED)
    return result, [file for file in files if file.path not in failed]


def archive_batch(spark: SparkSession, config: BatchConfig, record: BatchRecord) -> list[str]:
    """Move the files that the batch has loaded, and no others."""
    loaded = [file for file in record.open_files() if file.state == LOADED]
    moved = archive_files(spark, [file.path for file in loaded], config.archive, config.moves_at_once)
    record.write(loaded, ARCHIVED)
    return moved


def run_batch(spark: SparkSession, config: BatchConfig, batch_id: str) -> BatchResult:
    """Back up, load and archive all month files of the drop folder as one batch.

    Every step is recorded per file. After a failure, running the same ``batch_id`` again
    goes on with the files it had taken: loaded ones are only archived, and rows of a file
    that was half loaded are replaced. A file that comes or is repaired later may be loaded
    under the same ``batch_id``; its rows are added, or replace those of the same file name.
    Files with a wrong header or a failed backup are left where they are and named in the
    result.
    """
    record = record_of(spark, config, batch_id)
    files, skipped = record.take(config.new_files)
    backup, files = back_up(spark, config, record, files)
    fresh = [file for file in files if file.state == TAKEN]
    if not files:
        raise FileNotFoundError(f"no usable CSV file in {config.new_files}; skipped: {skipped + backup.failed}")
    report: dict[str, int] = {}
    if fresh:
        report = load_events(events_of(spark, fresh), config, batch_id, [file.name for file in fresh]).report
        record.write(fresh, LOADED)
    archived = archive_batch(spark, config, record)
    return BatchResult(batch_id, report, backup, skipped, archived)

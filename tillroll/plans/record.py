"""Which files a batch has taken, loaded and archived, as a table beside the others.

A batch finishes the files it has taken before it takes more. So the steps of a batch work
on the same files, also if they run apart and files are dropped in between, and a batch that
failed half-way goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import EVENT_SCHEMA
from tillroll.sources import FileFacts, SkippedFile, append_rows, create_table_if_missing, usable_files
from tillroll.sources.files import exists

#: In this order.
TAKEN, LOADED, ARCHIVED, REFUSED = "taken", "loaded", "archived", "refused"

SCHEMA = "batch_id string, name string, path string, length bigint, modified bigint, state string, step bigint"


@dataclass(frozen=True)
class RecordedFile(FileFacts):
    state: str


class BatchRecord:
    """The record of one batch. A few rows per file; the last one of a file counts."""

    def __init__(self, spark: SparkSession, table: str, batch_id: str):
        self.spark, self.table, self.batch_id = spark, table, batch_id
        create_table_if_missing(spark, table, spark.createDataFrame([], SCHEMA).schema)

    def _rows(self):
        return self.spark.table(self.table).where(F.col("batch_id") == self.batch_id)

    def open_files(self) -> list[RecordedFile]:
        """Files taken or loaded, but not archived or refused."""
        last = self._rows().groupBy("name").agg(
            F.max_by(F.struct("path", "length", "modified", "state"), "step").alias("f")
        )
        rows = last.where(F.col("f.state").isin(TAKEN, LOADED)).select("name", "f.*").orderBy("path")
        return [RecordedFile(r.path, r.name, r.length, r.modified, r.state) for r in rows.toLocalIterator()]

    def write(self, files: Sequence[FileFacts], state: str) -> None:
        if not files:
            return
        step = (self._rows().agg(F.max("step")).first()[0] or 0) + 1
        rows = [(self.batch_id, f.name, f.path, f.length, f.modified, state, step) for f in files]
        append_rows(self.spark.createDataFrame(rows, SCHEMA).coalesce(1), self.table)

    def take(self, folder: str) -> tuple[list[RecordedFile], list[SkippedFile]]:
        """The open files, or else the usable ones in ``folder``, which are open from now on.

        A file that was loaded and has already been moved is recorded as archived.
        """
        files = self.open_files()
        gone = [f for f in files if not exists(self.spark, f.path)]
        if lost := [f.path for f in gone if f.state == TAKEN]:
            raise FileNotFoundError(f"taken by batch {self.batch_id} and gone: {', '.join(lost)}")
        self.write(gone, ARCHIVED)
        files = [f for f in files if f not in gone]
        if files:
            return files, []
        usable, skipped = usable_files(self.spark, folder, EVENT_SCHEMA.fieldNames())
        self.write(usable, TAKEN)
        return [RecordedFile(f.path, f.name, f.length, f.modified, TAKEN) for f in usable], skipped

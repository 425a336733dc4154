"""Incremental load: every new month file once, as a file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.batch import BatchConfig, load_events
from tillroll.schemas import EVENT_SCHEMA
from tillroll.sources import SOURCE_FILE, with_source_file
from tillroll.sources.csv_files import CSV_ENDING
from tillroll.sources.files import exists, first_line


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    return folder


def feed_id(spark: SparkSession, checkpoint: str) -> str:
    """An id that is written into a checkpoint at its first use and lives as long as it."""
    path = f"{checkpoint}/feed-id"
    if not exists(spark, path):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
        try:
            stream.write(bytearray(uuid.uuid4().hex[:12].encode()))
        finally:
            stream.close()
    return first_line(spark, path)


def start_ingest(
    spark: SparkSession, config: BatchConfig, feed: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Load the files not loaded before and stop; run it again for later files.

    ``feed`` names the checkpoint. A batch is named by the feed, the checkpoint's own id and
    the number of the micro-batch: one that is repeated after a failure replaces its own
    rows, and a new checkpoint adds batches of its own. Duplicates are removed within a
    micro-batch, as within a batch. A file is archived by the run after the one that loaded
    it; the stream makes no raw copy of it.

    A file whose header is not that of a month file stops the stream with an error before
    any of its micro-batch is loaded: take the file away and start it again.
    """
    checkpoint = f"{shared_folder(spark)}/{feed}"
    name = f"{feed}-{feed_id(spark, checkpoint)}"

    def load(events: DataFrame, number: int) -> None:
        names = [r[0] for r in events.select(SOURCE_FILE).distinct().toLocalIterator()]
        load_events(events, config, f"{name}-{number:06d}", names)

    reader = (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", f"*{CSV_ENDING}")
        .option("cleanSource", "archive")
        .option("sourceArchiveDir", config.archive)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        with_source_file(reader.csv(config.new_files))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

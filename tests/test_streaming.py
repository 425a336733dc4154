from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from tests import mini
from tillroll.plans.batch import BatchConfig, load_events
from tillroll.sources import drop_table, read_events, with_source_file
from tillroll.streaming import ingest, start_ingest


@pytest.fixture
def config(spark, tmp_path):
    made = BatchConfig(
        new_files=str(tmp_path / "new"),
        archive=str(tmp_path / "done"),
        staging_table="stream_staging",
        activity_table="stream_activity",
        master_table="stream_master",
        batch_date=dt.date(2020, 3, 1),
    )
    yield made
    for name in (made.activity_table, made.master_table):
        drop_table(spark, name)


def run(spark, config, feed):
    query = start_ingest(spark, config, feed)
    query.awaitTermination()
    assert query.exception() is None


def test_each_file_is_loaded_once(spark, config, tmp_path):
    mini.write(tmp_path / "new", "2019-Oct.csv", mini.HEADER + mini.LINES)
    run(spark, config, tmp_path.name)
    run(spark, config, tmp_path.name)
    assert spark.table(config.activity_table).count() == 2

    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    run(spark, config, tmp_path.name)
    activity = spark.table(config.activity_table)
    assert activity.groupBy("batch_id").count().count() == 2
    assert activity.count() == 5
    assert spark.table(config.master_table).count() == 3
    # The first file is archived by the run that loaded the second.
    assert [path.name for path in (tmp_path / "done").rglob("*.csv")] == ["2019-Oct.csv"]


def test_another_header_stops_the_stream(spark, config, tmp_path):
    swapped = mini.HEADER.replace("product_id,category_id", "category_id,product_id")
    mini.write(tmp_path / "new", "2019-Nov.csv", swapped + mini.NEXT_MONTH)
    query = start_ingest(spark, config, f"{tmp_path.name}-swapped")
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert not spark.catalog.tableExists(config.activity_table) or spark.table(config.activity_table).count() == 0


def test_a_new_checkpoint_keeps_old_batches(spark, config, tmp_path):
    mini.write(tmp_path / "new", "2019-Oct.csv", mini.HEADER + mini.LINES)
    run(spark, config, f"{tmp_path.name}-feed")
    folder = Path(ingest.shared_folder(spark)) / f"{tmp_path.name}-feed"
    first = ingest.feed_id(spark, str(folder))
    assert ingest.feed_id(spark, str(folder)) == first
    folder.rename(folder.with_name("away"))
    (tmp_path / "new" / "2019-Oct.csv").rename(tmp_path / "2019-Oct.csv")
    mini.write(tmp_path / "new", "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    run(spark, config, f"{tmp_path.name}-feed")
    assert ingest.feed_id(spark, str(folder)) != first
    assert spark.table(config.activity_table).count() == 5


def test_a_batch_that_is_repeated_replaces_its_rows(spark, config, tmp_path):
    path = mini.write(tmp_path, "2019-Nov.csv", mini.HEADER + mini.NEXT_MONTH)
    for _ in range(2):
        load_events(with_source_file(read_events(spark, path)), config, "feed-0", ["2019-Nov.csv"])
    assert spark.table(config.activity_table).count() == 3


def test_shared_folder_is_taken_from_the_session(spark):
    assert ingest.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

"""Month files: finding, checking and reading them."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schemas import EVENT_SCHEMA
from tillroll.sources.files import FileFacts, first_line, list_files, plain_path

CSV_ENDING = ".csv"
SOURCE_FILE = "source_file"

# What reading a broken file raises: while planning, or from a job.
FILE_ERRORS = (PySparkException, Py4JJavaError)


@dataclass(frozen=True)
class SkippedFile:
    path: str
    reason: str


def reason_of(error: Exception) -> str:
    cause = error.java_exception if isinstance(error, Py4JJavaError) else error
    return str(cause).partition("\n")[0]


def find_csv(spark: SparkSession, folder: str) -> list[FileFacts]:
    """The ``*.csv`` files directly in ``folder``; no file is opened."""
    return list_files(spark, folder, CSV_ENDING)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line, read through the file system without a job."""
    line = first_line(spark, path)
    return next(csv.reader([line.removeprefix("﻿")]), []) if line else []


def usable_files(
    spark: SparkSession, folder: str, columns: Sequence[str] = (), files_at_once: int = 16
) -> tuple[list[FileFacts], list[SkippedFile]]:
    """The files whose header starts with ``columns``, and the others with a reason.

    Only the first line of each file is read, by the driver and without a Spark job. Fields
    are matched by position later, so a file with another header would load wrong values
    without any error.
    """

    def problem(file: FileFacts) -> str | None:
        try:
            header = header_of(spark, file.path)
        except FILE_ERRORS as error:
            return reason_of(error)
        if not header:
            return "empty file"
        return None if header[: len(columns)] == list(columns) else f"unexpected header: {', '.join(header)}"

    files = find_csv(spark, folder)
    with ThreadPoolExecutor(files_at_once) as pool:
        problems = list(zip(files, pool.map(problem, files), strict=True))
    usable = [file for file, reason in problems if reason is None]
    return usable, [SkippedFile(file.path, reason) for file, reason in problems if reason is not None]


def _plain(paths: str | Sequence[str]) -> list[str]:
    return [plain_path(path) for path in ([paths] if isinstance(paths, str) else paths)]


def read_events(
    spark: SparkSession, paths: str | Sequence[str], corrupt_column: str | None = None
) -> DataFrame:
    """Events with their fixed types; a cell of another type becomes NULL, its row stays.

    ``corrupt_column`` names an added column with the text of such rows. Paths are names,
    not patterns.
    """
    schema, reader = EVENT_SCHEMA, spark.read.option("header", True)
    if corrupt_column is not None:
        schema = T.StructType([*EVENT_SCHEMA, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).csv(_plain(paths))


def with_source_file(df: DataFrame) -> DataFrame:
    """Rows of a file source with the name of their file, which Spark gives URL-encoded."""
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    return df.withColumn(SOURCE_FILE, F.url_decode(encoded))


def read_inferred(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files with types taken from all of their values, which reads them once more."""
    reader = spark.read.option("header", True).option("inferSchema", True)
    return reader.csv(_plain(paths))

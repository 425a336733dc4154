"""Raw copies of the month files, one table per file."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tillroll.functions import table_name_for_file
from tillroll.operators import stamp_processed_date
from tillroll.sources import SkippedFile, read_inferred, replace_table
from tillroll.sources.csv_files import FILE_ERRORS, reason_of

# The table property that names the file a backup was made from.
SOURCE_PROPERTY = "tillroll.source_path"


@dataclass(frozen=True)
class BackupResult:
    tables: list[str] = field(default_factory=list)
    failed: list[SkippedFile] = field(default_factory=list)


def backup_names(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Table name to file path. Two files whose names are equal but for case raise, since
    the catalog takes them as one."""
    named = spark.createDataFrame([(path,) for path in paths], "path string").select(
        "path", table_name_for_file(F.element_at(F.split("path", "/"), -1)).alias("name")
    )
    tables: dict[str, str] = {}
    seen: dict[str, str] = {}
    for row in named.toLocalIterator():
        other = seen.setdefault(row.name.lower(), row.path)
        if other != row.path:
            raise ValueError(f"{row.path} and {other} would both be table {row.name}")
        tables[row.name] = row.path
    return tables


def source_of(spark: SparkSession, table: str) -> str | None:
    """The file that an existing backup table was made from."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == SOURCE_PROPERTY)
    return (rows.first() or {"value": ""})["value"]


def backup_csv(
    spark: SparkSession,
    paths: Sequence[str],
    batch_date: dt.date | None = None,
    database: str | None = None,
    files_at_once: int = 4,
) -> BackupResult:
    """Store every file as a table of its own, replacing an earlier copy of it.

    Types are inferred per file, from all of its values. Writing a file is one job without
    a shuffle, spread over the parts of the file; a few files are written at once so that
    small ones do not leave the cluster idle. A file that fails is named in the result, and
    so is one whose table holds the copy of a file at another path.
    """
    prefix = f"{database}." if database else ""

    def store(item: tuple[str, str]) -> SkippedFile | None:
        table, path = prefix + item[0], item[1]
        try:
            other = source_of(spark, table)
            if other is not None and other != path:
                return SkippedFile(path, f"table {table} is the backup of {other or 'something else'}")
            replace_table(stamp_processed_date(read_inferred(spark, path), batch_date), table)
            quoted = path.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{SOURCE_PROPERTY}' = '{quoted}')")
        except FILE_ERRORS as error:
            return SkippedFile(path, reason_of(error))
        return None

    names = backup_names(spark, paths)
    with ThreadPoolExecutor(files_at_once) as pool:
        failures = list(pool.map(store, names.items()))
    return BackupResult(
        [prefix + name for name, failure in zip(names, failures, strict=True) if failure is None],
        [failure for failure in failures if failure is not None],
    )

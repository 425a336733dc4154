"""Tables of a relational database, read and written in parallel."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Where a database is. User and password come from the environment."""

    url: str
    driver: str | None = None
    user_variable: str = "TILLROLL_DB_USER"
    password_variable: str = "TILLROLL_DB_PASSWORD"

    def properties(self) -> dict[str, str]:
        found = {
            "user": os.environ.get(self.user_variable),
            "password": os.environ.get(self.password_variable),
            "driver": self.driver,
        }
        return {name: value for name, value in found.items() if value}


@dataclass(frozen=True)
class Split:
    """How a table is read by several tasks.

    By equal ranges of a numeric, date or timestamp column, or, where its values are
    unevenly spread, by one condition per task; these must cover every row exactly once.
    """

    column: str | None = None
    lower: object = None
    upper: object = None
    partitions: int = 1
    predicates: Sequence[str] = field(default_factory=tuple)


#: Said for small tables only: everything comes through one connection and one task.
SINGLE_CONNECTION = Split()


def read_table(
    spark: SparkSession,
    database: Database,
    table: str,
    split: Split,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A database table; filters and column lists are sent to the database.

    ``SINGLE_CONNECTION`` as ``split`` reads a small table through one connection.
    """
    properties = {**database.properties(), "fetchsize": str(fetch_size)}
    if split == SINGLE_CONNECTION:
        return spark.read.jdbc(database.url, table, properties=properties)
    if split.predicates:
        return spark.read.jdbc(
            database.url, table, predicates=list(split.predicates), properties=properties
        )
    return spark.read.jdbc(
        database.url,
        table,
        column=split.column,
        lowerBound=split.lower,
        upperBound=split.upper,
        numPartitions=split.partitions,
        properties=properties,
    )


def even_split(
    spark: SparkSession, database: Database, table: str, column: str, partitions: int
) -> Split:
    """Ranges over the column's own smallest and largest value, asked of the database."""
    query = f"(SELECT MIN({column}) AS lowest, MAX({column}) AS highest FROM {table}) bounds"
    bounds = read_table(spark, database, query, SINGLE_CONNECTION).first()
    if bounds is None or bounds["lowest"] is None:
        return SINGLE_CONNECTION
    return Split(column, bounds["lowest"], bounds["highest"], partitions)


def write_table(
    df: DataFrame,
    database: Database,
    table: str,
    mode: str = "append",
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Append to or replace a database table.

    ``connections`` bounds how many tasks write at once. Replacing keeps the table
    definition (``truncate``), so that its constraints outlast the write.
    """
    properties = {
        **database.properties(),
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
        "truncate": "true",
    }
    df.write.jdbc(database.url, table, mode=mode, properties=properties)


def catalog_settings(name: str, database: Database) -> dict[str, str]:
    """Session settings that mount a database as catalog ``name``.

    ``name.schema.table`` then works wherever a table name does, in ``spark.sql`` and
    for creating and dropping tables.
    """
    prefix = f"spark.sql.catalog.{name}"
    settings = {
        prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        f"{prefix}.url": database.url,
    }
    return settings | {f"{prefix}.{key}": value for key, value in database.properties().items()}

"""Catalog tables: creating, replacing, appending, dropping."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_table_if_missing(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    provider: str | None = "parquet",
) -> None:
    """Create an empty table; ``provider`` None leaves the storage to the catalog."""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}{'' if field.nullable else ' NOT NULL'}"
        for field in schema
    )
    using = f" USING {provider}" if provider else ""
    layout = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}){using}{layout}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Write ``df`` as the whole content of a table, which ``df`` must not read."""
    df.write.format("parquet").mode("overwrite").partitionBy(*partition_by).saveAsTable(name)


def append_rows(df: DataFrame, name: str) -> None:
    """Append to an existing table, columns matched by name."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def replace_partitions(df: DataFrame, name: str, outer: Sequence[str], values: Sequence[Sequence[str]]) -> None:
    """Make ``df`` the only rows of the partitions with these ``values`` of the ``outer`` keys.

    ``outer`` are the first partition columns. Everything else stays as it is, and so a load
    that is repeated replaces its own rows only, also in inner partitions that the new rows
    no longer reach. The old partitions go first: after a failure in between, repeat the load.
    """
    spark = df.sparkSession
    partitions = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    if partitions[: len(outer)] != list(outer):
        raise ValueError(f"{name} is not partitioned by {', '.join(outer)} first")
    old = []
    for combination in values:
        spec = ", ".join(f"{key} = '{_quoted(value)}'" for key, value in zip(outer, combination, strict=True))
        for row in spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").collect():  # the days of one file
            pairs = [part.split("=", 1) for part in row[0].split("/")]
            old.append(", ".join(f"{key} = '{_quoted(unquote(value))}'" for key, value in pairs))
    if old:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({spec})" for spec in old))
    append_rows(df, name)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")

"""What the operators share: tables in the shared folder, and joins that bear hot keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot if it has more than one row in so many; there are at most this many hot keys.
HOT_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's ``spark.checkpoint.dir``.

    Where that is unset, as in tests on one machine, the session gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="tillroll-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/tillroll/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there: its lineage ends here."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_in(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def join_counted(left: DataFrame, keys: DataFrame, key: str | list[str], copies: str, total: int) -> DataFrame:
    """Inner join of rows with one row per key, where a key may have any share of the rows.

    ``keys[copies]`` is the number of rows of ``left`` that have the key, ``total`` that of
    all rows, so at most ``HOT_KEYS`` keys can be hot and only these are broadcast. Both
    sides should be stored tables, since each is read twice. Keys are not null.
    """
    names = [key] if isinstance(key, str) else key
    is_hot = F.col(copies) * HOT_KEYS > F.lit(total)
    hot = F.broadcast(keys.where(is_hot))
    return left.join(hot, names).unionByName(
        left.join(hot.select(*names), names, "left_anti").join(keys.where(~is_hot), names)
    )


def columns_free_of(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, made from ``names``."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free

"""Listing, reading the first line of, and moving files on any file system Spark can reach."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Characters that Spark's readers take as a pattern in a path.
PATTERN_CHARACTERS = "\\{}[]*?"


@dataclass(frozen=True)
class FileFacts:
    """A file as it was listed; another length or time means another content."""

    path: str
    name: str
    length: int
    modified: int


def _file_system(spark: SparkSession, folder: str):
    """A Hadoop path and its file system; only names and moves go through the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, folder: str, ending: str) -> list[FileFacts]:
    """The files directly in ``folder`` whose name ends so, empty files too, by path."""
    path, system = _file_system(spark, folder)
    found = [
        FileFacts(s.getPath().toString(), s.getPath().getName(), s.getLen(), s.getModificationTime())
        for s in system.listStatus(path)
        if s.isFile() and s.getPath().getName().endswith(ending)
    ]
    return sorted(found, key=lambda file: file.path)


def plain_path(path: str) -> str:
    """``path`` for Spark's readers, with nothing in it taken as a pattern."""
    return "".join(f"\\{c}" if c in PATTERN_CHARACTERS else c for c in path)


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file in UTF-8, without a Spark job; None if it is empty."""
    java = spark._jvm.java.io
    source, system = _file_system(spark, path)
    reader = java.BufferedReader(java.InputStreamReader(system.open(source), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def exists(spark: SparkSession, path: str) -> bool:
    source, system = _file_system(spark, path)
    return system.exists(source)


def archive_files(spark: SparkSession, paths: Sequence[str], folder: str, files_at_once: int = 16) -> list[str]:
    """Move files into ``folder``, creating it; returns the new paths.

    No file is moved if the name of any is already there or two have the same name: that
    raises. A few files are moved at once, as an object store copies them.
    """
    target, system = _file_system(spark, folder)
    system.mkdirs(target)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    moves = [(hadoop_path(path), hadoop_path(target, hadoop_path(path).getName())) for path in paths]
    destinations = [destination.toString() for _, destination in moves]
    if len(set(destinations)) < len(destinations):
        raise FileExistsError(f"two files would get the same name in {folder}")
    with ThreadPoolExecutor(files_at_once) as pool:
        taken = [d for d, there in zip(destinations, pool.map(lambda m: system.exists(m[1]), moves)) if there]
        if taken:
            raise FileExistsError(f"already archived, no file was moved: {', '.join(taken)}")

        def move(pair: tuple) -> str:
            if not system.rename(*pair):
                raise OSError(f"cannot move {pair[0].toString()} to {pair[1].toString()}")
            return pair[1].toString()

        return list(pool.map(move, moves))

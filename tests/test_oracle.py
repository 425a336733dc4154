"""Every registered query against the SQL engine on whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tests.compare import rows_of
from tests.conftest import SF_DIR
from tillroll.plans import registered

# The library's own queries; those of the optional subpackage have tests of their own.
QUERIES = dict(registered.QUERIES)
ORACLE = {name: sql for name, sql in entry_module.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = oracle.execute(ORACLE[name])
    names = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    rows = ours.collect()
    assert rows, "no rows"
    assert rows_of(ours.columns, rows) == rows_of(names, theirs.fetchall())


def test_entry_gives_ten_products(spark):
    assert entry_module.entry(spark).count() == 10

"""Whitening against numpy, with whole numbers of any size, and odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries, whitening

SMALL = "/root/testdata/sf0.001"


def expected(vectors: np.ndarray, components: int):
    """Exact deviations, unsigned whitened values and shares, of rows of doubles."""
    x = np.floor(1024 * vectors.astype(float)).astype(int).astype(object) + 100_000
    n, total = len(x), x.sum(axis=0)
    far = n * x - total
    centred = (far / n).astype(float)
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1][:components], parts[:, ::-1][:, :components]
    return (far**2).sum(axis=1), centred @ parts / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def by_row(rows, ids, components):
    table = {(r[0], r.component): r for r in rows}
    return np.array([[table[i, c].whitened for c in range(1, components + 1)] for i in ids])


def test_query_against_numpy(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    rows = queries.QUERIES["op11_whitening"](spark, SMALL).collect()
    deviation, white, share = expected(np.array([r.embedding for r in table], np.float32), 8)
    ids = [r.vec_id for r in table]
    got = by_row(rows, ids, 8)
    signs = np.sign((got * white).sum(axis=0))
    assert len(rows) == 8 * len(ids) and np.allclose(got, white * signs, rtol=1e-9, atol=1e-9)
    assert {(r.vec_id, r.deviation) for r in rows} == set(zip(ids, deviation, strict=True))
    assert all(abs(r.explained / share[r.component - 1] - 1) < 1e-10 and r.n == len(ids) for r in rows)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-10


@pytest.fixture(scope="module")
def odd():
    draw = np.random.default_rng(3)
    rows = [(k, draw.normal(size=5).tolist(), k) for k in range(40)]
    rows += [rows[0], rows[0], (None, rows[1][1], 1)]
    bad = [(50, None, 0), (51, [1.0, None, 0.0, 0.0, 0.0], 0), (52, [float("nan")] + [0.0] * 4, 0),
           (53, [float("-inf")] + [0.0] * 4, 0), (54, [], 0), (55, [1.0, 2.0], 0)]
    return rows, bad


@pytest.mark.parametrize(("most_blocks", "rows_in_block"), [(1000, 4), (3, 15)])
def test_odd_rows_in_many_blocks(spark, monkeypatch, odd, most_blocks, rows_in_block):
    monkeypatch.setattr(whitening, "BLOCK_NUMBERS", 20)
    monkeypatch.setattr(whitening, "TASK_NUMBERS", 60)
    monkeypatch.setattr(whitening, "MOST_BLOCKS", most_blocks)
    assert whitening.rows_per_block(43, 5) == rows_in_block
    rows, bad = odd
    table = spark.createDataFrame(rows + bad, "n long, vec array<double>, x long").repartition(4)
    got = whitening.whiten(table, "vec", "n", components=3)
    assert got.columns == ["n_", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = got.collect()
    deviation, white, _ = expected(np.array([v for _, v, _ in rows]), 3)
    assert len(found) == 3 * len(rows) and found[0].identity_error < 1e-10
    assert sorted(r.deviation for r in found if r.component == 1) == sorted(deviation)
    for c in range(3):
        ours = sorted(r.whitened for r in found if r.component == c + 1)
        assert any(np.allclose(ours, sorted(s * white[:, c]), atol=1e-9) for s in (1, -1))


def test_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(3, [1.0, 2.0])], schema)).collect()
    assert [tuple(r) for r in one] == [(3, k, 1, 0, None, None, None) for k in (1, 2)]
    line = spark.createDataFrame([(k, [float(k), 0.5]) for k in range(4)], schema)
    first, second = (whitening.whiten(line).where(F.col("component") == c).collect() for c in (1, 2))
    assert {r.whitened for r in second} == {None} and {r.explained for r in second} == {0.0}
    assert np.isclose(np.var([r.whitened for r in first]), 1) and first[0].identity_error < 1e-12


def test_numbers_beyond_64_bits(spark):
    schema = "vec_id long, embedding array<double>"
    big = [(k, [s * 1e9 * (k + 1), 1.0]) for k in range(3) for s in (1, -1)]
    rows = whitening.whiten(spark.createDataFrame(big, schema), components=1).collect()
    assert {(r.vec_id, r.deviation) for r in rows} == {(k, None) for k in range(3)}
    near = [(k, [1e5 * k, 1.0]) for k in range(6)]  # decimal sums that still fit
    rows = whitening.whiten(spark.createDataFrame(near, schema), components=1).collect()
    deviation, _, _ = expected(np.array([v for _, v in near]), 1)
    assert [r.deviation for r in sorted(rows)] == list(deviation)
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0])], schema), components=1).collect()
    assert len(huge) == 2 and {r.deviation for r in huge} == {None}

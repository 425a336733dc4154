"""Whitening of embeddings by Spark MLlib's distributed block matrices.

The centred rows are indexed and gathered into blocks of a ``BlockMatrix``. Its transpose times
itself is the scatter matrix, of one entry for each pair of dimensions; the driver takes that
apart into eigenvectors; and the block matrix times the whitening matrix projects all rows.
All of this is JVM work on DataFrames and MLlib's matrices.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import columns_free_of, stored

SCALE, SHIFT = 1024, 100_000
#: Components that are returned, at most.
COMPONENTS = 8
#: Numbers in a block (8 bytes each), and in the blocks that one task multiplies, on the mean.
BLOCK_NUMBERS, TASK_NUMBERS = 131_072, 2_097_152
#: Beyond so many blocks they get larger instead, as MLlib keeps the ids of all on the driver.
MOST_BLOCKS = 250_000
#: An eigenvalue below so much of the variance of all dimensions counts as zero.
LEAST_VARIANCE = 1e-12
#: The largest size of a scaled entry: differences of two still have 64 bits.
FURTHEST = 2**61
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(entry: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """An entry as a whole number; beyond ``FURTHEST``, either way, it counts as that."""
    far = F.lit(float(FURTHEST))
    return F.floor(F.greatest(-far, F.least(far, entry.cast("double") * F.lit(float(scale))))) + F.lit(shift)


def is_usable(vector: Column) -> Column:
    """Neither null nor holding null, NaN or infinite entries."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` stored with an ``index`` from 0 without gaps, and how many there are.

    Rows are numbered within their tasks when they are written; the driver adds up one count
    for each task.
    """
    number = F.monotonically_increasing_id()
    kept = stored(rows.select("*", F.spark_partition_id().alias("task"), number.alias("number")), "vectors")
    counts = sorted(kept.groupBy("task").agg(F.min("number"), F.count(F.lit(1))).collect())
    before = [0, *itertools.accumulate(c for _, _, c in counts)]
    first = [(task, at - least) for (task, least, _), at in zip(counts, before, strict=False)]
    first_of_task = rows.sparkSession.createDataFrame(first, "task int, shift long")
    joined = kept.join(F.broadcast(first_of_task), "task")  # 12 bytes for each task
    return joined.withColumn("index", F.col("number") + F.col("shift")).drop("task", "number", "shift"), before[-1]


def _sums(rows: DataFrame, dims: int) -> tuple[list[int], list[int], list[int]]:
    """Of each dimension the exact sum, the smallest and the largest number."""
    each = rows.select(F.posexplode("x").alias("dim", "x"))
    found = each.groupBy("dim").agg(F.sum(F.col("x").cast("decimal(20,0)")), F.min("x"), F.max("x")).collect()
    by_dim = {r[0]: r for r in found}
    sums, least, most = zip(*[(int(by_dim[k][1]), by_dim[k][2], by_dim[k][3]) for k in range(dims)], strict=True)
    return list(sums), list(least), list(most)


def _deviation(n: int, sums: list[int], least: list[int], most: list[int]) -> Column:
    """The sum over dimensions of ``(n * x - sum)`` squared, exact; null if beyond 64 bits."""
    furthest = max(max(abs(n * v - s) for v in (a, b)) for s, a, b in zip(sums, least, most, strict=True))
    largest = max(n * max(abs(a), abs(b)) for a, b in zip(least, most, strict=True))
    if max(len(sums) * furthest**2, largest, *map(abs, sums)) < 2**63:  # then no step is beyond 64 bits
        of = F.array(*[F.lit(s).cast("long") for s in sums])
        far = F.transform("x", lambda c, i: c * F.lit(n).cast("long") - F.get(of, i))
        return F.aggregate(far, F.lit(0).cast("long"), lambda total, d: total + d * d)
    of = F.array(*[F.lit(str(s)).cast("decimal(38,0)") for s in sums])
    wide, times = "decimal(38,0)", F.lit(n).cast("decimal(19,0)")
    scaled = F.transform("x", lambda c: F.try_multiply(c.cast("decimal(19,0)"), times).cast(wide))
    far = F.transform(scaled, lambda d, i: F.try_subtract(d, F.get(of, i)).cast(wide))
    total = F.aggregate(far, F.lit(0).cast(wide), lambda t, d: F.try_add(t, F.try_multiply(d, d)).cast(wide))
    return total.try_cast("long")


def _centred(n: int, sums: list[int]) -> Column:
    """``x`` less its mean: the whole part first, which is exact, then the fraction."""
    whole = F.array(*[F.lit(s // n).cast("long") for s in sums])
    fraction = F.array(*[F.lit(s % n / n) for s in sums])
    return F.transform("x", lambda c, i: (c - F.get(whole, i)).cast("double") - F.get(fraction, i))


def rows_per_block(n: int, dims: int) -> int:
    return max(1, BLOCK_NUMBERS // dims, -(-n // MOST_BLOCKS))


def block_matrix(rows: DataFrame, vector: str, n: int, dims: int) -> BlockMatrix:
    """Blocks of whole rows, at the places that ``index`` gives; at most ``MOST_BLOCKS``."""
    indexed = rows.select("index", array_to_vector(F.col(vector)).alias("vector"))
    indexed = MLUtils.convertVectorColumnsFromML(indexed, "vector")
    return IndexedRowMatrix(indexed, n, dims).toBlockMatrix(rows_per_block(n, dims), dims)


def transpose_times(blocks: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix itself. The rows' blocks are dealt to tasks, and their
    products are summed up; without that split all blocks would go to one task."""
    per_task = max(1, TASK_NUMBERS // (blocks.rowsPerBlock * blocks.colsPerBlock))
    splits = -(-blocks.numRowBlocks // per_task)
    java = blocks._java_matrix_wrapper._java_model
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", java, splits)
    return BlockMatrix(product, blocks.colsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors by falling eigenvalue, each over the root of its own, and their
    eigenvalues. Columns of eigenvalues that count as zero are zero."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    usable = values > LEAST_VARIANCE * max(np.trace(covariance), 0.0)
    return vectors * np.where(usable, 1 / np.sqrt(np.where(usable, values, 1.0)), 0.0), np.where(usable, values, 0.0)


def project(blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``(index, projected)``: each row times ``matrix``."""
    dims, components = matrix.shape
    spark_context = blocks.blocks.context
    block = DenseMatrix(dims, components, matrix.flatten(order="F"))
    factor = BlockMatrix(spark_context.parallelize([((0, 0), block)], 1), dims, components)
    rows = callMLlibFunc("getIndexedRows", blocks.multiply(factor).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array("vector").alias("projected"))


def _pairs(components: int) -> Iterator[tuple[int, int]]:
    return itertools.combinations_with_replacement(range(components), 2)


def whiten(
    table: DataFrame,
    vector: str = "embedding",
    row_id: str = "vec_id",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """One row for each usable vector and component: the id, ``component`` from 1, ``n``,
    ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Null vectors and those with null or non-finite entries are dropped, and so are vectors of
    another length than the most frequent one (of lengths that are as frequent, the longest)
    and empty ones. Null and repeated ids are ordinary: each row counts. Components whose
    variance is zero but for rounding, as with one row or equal rows, have null ``whitened``
    and an ``explained`` of 0 (null if there is no variance at all); ``identity_error`` is
    over the others. A ``deviation`` beyond 64 bits is null. Other columns aren't read. An
    empty table gives no rows.
    """
    spark = table.sparkSession
    entries = F.transform(F.col(vector), lambda c: whole_numbers(c, scale, shift))
    usable = table.where(is_usable(F.col(vector))).select(F.col(row_id).alias("id"), entries.alias("x"))
    usable = usable.where(F.size("x") > 0)
    (id_name,) = columns_free_of(spark.createDataFrame([], RESULT), row_id)
    lengths = usable.groupBy(F.size("x").alias("dims")).count()
    dims = lengths.orderBy(F.desc("count"), F.desc("dims")).select("dims").first()
    if dims is None:
        empty = spark.createDataFrame([], RESULT)
        return empty.select(F.lit(None).cast(table.schema[row_id].dataType).alias(id_name), "*")

    rows, n = _numbered(usable.where(F.size("x") == dims[0]))
    sums, least, most = _sums(rows, dims[0])
    centred = rows.select("index", _centred(n, sums).alias("centred"))
    blocks = block_matrix(centred, "centred", n, dims[0])
    covariance = transpose_times(blocks) / n
    matrix, values = whitening_matrix(covariance, min(components, dims[0]))
    white = stored(project(blocks, matrix), "whitened")

    there = [k for k, e in enumerate(values) if e > 0]
    pairs = [(a, b) for a, b in _pairs(len(values)) if a in there and b in there]
    error = None
    if pairs:
        found = white.agg(*[F.covar_pop(F.get("projected", F.lit(a)), F.get("projected", F.lit(b))) for a, b in pairs]).first()
        error = max(abs(c - (a == b)) for c, (a, b) in zip(found, pairs, strict=True))
    trace = float(np.trace(covariance))
    each = [
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.get("projected", F.lit(k)) if k in there else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(e) / trace if trace > 0 else None).cast("double").alias("explained"),
        )
        for k, e in enumerate(values)
    ]
    joined = rows.join(white, "index").select("id", _deviation(n, sums, least, most).alias("deviation"), F.inline(F.array(*each)))
    return joined.select(
        F.col("id").alias(id_name), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"),
    )

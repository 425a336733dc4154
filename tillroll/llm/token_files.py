"""Token ids of all documents in ascending order, in files of shuffled bit or byte planes.

The documents are ordered by id with one range shuffle, and each range becomes a file: its
ids, document after document, cut into blocks of a fixed number of ids. A block is transposed
into planes, the first bytes (or bits) of all its ids, then the second ones, and so on; each
plane is compressed with zstandard for itself. A chunk is a block's planes and the documents
that begin in it. The index of the chunks says where in the whole sequence each one begins.

Chunks and index are rows of Parquet tables, written uncompressed, so that any store that
Spark can write to will do.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from tillroll.llm.common import shared_folder, stored
from tillroll.llm.word_texts import TextEncoder, packed

#: Ids in a block; only the last block of a file has fewer.
BLOCK_IDS = 65_536
#: Bytes of text that go into a file, on the mean.
FILE_BYTES = 64_000_000
#: Files whose beginnings are summed up in one step, and may be broadcast (12 bytes each).
STEP, BROADCAST_FILES = 4096, 500_000
#: Bytes of text that are encoded together, or one text if it is longer.
BYTES_AT_ONCE = 2_000_000
#: Bytes of ids in a batch of documents that are read.
BATCH_BYTES = 4_000_000
LEVEL = 3


class LibraryEncoder(TextEncoder):
    """Ids as the ``tokenizers`` library gives them: its model sees each different word, and
    it encodes texts with a special token in one piece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        tokenize = self.library.model.tokenize
        with open(path, encoding="utf-8") as file:
            super().__init__(json.load(file), lambda word: [t.id for t in tokenize(word)])

    def with_special(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    """One for each worker process."""
    return LibraryEncoder(path)


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of a block, lowest first, without the highest that are all zero."""
    ids = np.ascontiguousarray(ids, "<u4")
    width = int(ids.max()).bit_length() if len(ids) else 0
    if bits:
        return [np.packbits((ids >> b & 1).astype(np.uint8)).tobytes() for b in range(width)]
    rows = ids.view(np.uint8).reshape(-1, 4)
    return [np.ascontiguousarray(rows[:, b]).tobytes() for b in range(-(-width // 8))]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if bits:
        ids = np.zeros(n, "<u4")
        for b, plane in enumerate(planes):
            ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n).astype("<u4") << b
        return ids
    rows = np.zeros((n, 4), np.uint8)
    for b, plane in enumerate(planes):
        rows[:, b] = np.frombuffer(plane, np.uint8)
    return rows.view("<u4").reshape(n)


@dataclass(frozen=True)
class IdFiles:
    """``chunks (file, chunk, first, n_ids, crc32, planes, docs)`` and their ``index (file,
    chunk, start, n_ids, plane_bytes, n_docs, file_start)``. ``first`` counts in the file,
    ``start`` over all files."""

    chunks: DataFrame
    index: DataFrame
    bits: bool
    files: int


def _chunk_schema(doc_id: T.DataType) -> T.StructType:
    doc = T.StructType([T.StructField("doc_id", doc_id), T.StructField("n_tokens", T.LongType())])
    kinds = {"file": T.IntegerType(), "chunk": T.IntegerType(), "first": T.LongType(), "n_ids": T.IntegerType(),
             "crc32": T.LongType(), "planes": T.ArrayType(T.BinaryType()), "docs": T.ArrayType(doc)}
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _some_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``BYTES_AT_ONCE`` of text, or of one document."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _chunks(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int | None, block_ids: int, bits: bool
) -> Iterator[pa.RecordBatch]:
    """The chunks of one file, from its documents in order."""
    bpe, file = encoder(path), TaskContext.get().partitionId()
    press = zstandard.ZstdCompressor(level=LEVEL)
    end = packed([] if end_id is None else [end_id])
    size, chunk, first, waiting, docs = 4 * block_ids, 0, 0, bytearray(), []
    entry = None

    def row(data: bytes, begun: list) -> pa.RecordBatch:
        planes = [press.compress(p) for p in to_planes(np.frombuffer(data, "<u4"), bits)]
        columns = [pa.array([file], pa.int32()), pa.array([chunk], pa.int32()), pa.array([first], pa.int64()),
                   pa.array([len(data) // 4], pa.int32()), pa.array([zlib.crc32(data)], pa.int64()),
                   pa.array([planes], pa.list_(pa.binary())), pa.array([begun], pa.list_(entry))]
        return pa.RecordBatch.from_arrays(columns, names=_chunk_schema(T.LongType()).names)

    for batch in _some_texts(batches):
        entry = pa.struct([("doc_id", batch.column(0).type), ("n_tokens", pa.int64())])
        ids, starts = bpe.encode(batch.column(1))
        for doc_id, (a, b) in zip(batch.column(0).to_pylist(), itertools.pairwise(starts), strict=True):
            own = ids[a:b].tobytes() + end
            docs.append((first + len(waiting) // 4, {"doc_id": doc_id, "n_tokens": len(own) // 4}))
            waiting += own
            while len(waiting) >= size:
                stop = first + block_ids
                yield row(bytes(waiting[:size]), [d for at, d in docs if at < stop])
                docs = [d for d in docs if d[0] >= stop]
                del waiting[:size]
                chunk, first = chunk + 1, stop
    if waiting or docs:
        yield row(bytes(waiting), [d for _, d in docs])


def _starts(totals: DataFrame) -> DataFrame:
    """``(file, file_start)`` from ``(file, n)``, in two steps: no task gets all files."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("step", F.floor(F.col("file") / STEP))
    steps = totals.groupBy("step").agg(F.sum("n").alias("n"))
    steps = steps.select("step", F.sum("n").over(before.orderBy("step")).alias("step_start"))
    inside = F.sum("n").over(before.partitionBy("step").orderBy("file"))
    start = F.coalesce("step_start", F.lit(0)) + F.coalesce("inside", F.lit(0))
    return totals.withColumn("inside", inside).join(steps, "step").select("file", start.alias("file_start"))


def write_ids(
    docs: DataFrame,
    path: str,
    end_id: int | None,
    text: str = "text",
    doc_id: str = "doc_id",
    block_ids: int = BLOCK_IDS,
    bits: bool = False,
    file_bytes: int = FILE_BYTES,
) -> IdFiles:
    """Encode each whole text with the tokenizer at ``path``, append ``end_id``, write files.

    Documents are in ascending order of their id, null first; those of equal id in an order
    that their texts give. Null and empty texts have the end id alone, or no ids if
    ``end_id`` is None. Repeated rows are documents each; the range shuffle splits an id that
    many rows share. Other columns are not read. An empty table gives no files.
    """
    column = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).alias("doc_id"), column.alias("text"), F.xxhash64(column).alias("of_text"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    # The running number only parts rows whose ids and texts are both equal.
    ordered = rows.withColumn("salt", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(files, "doc_id", "of_text", "salt")
    ordered = ordered.sortWithinPartitions("doc_id", "of_text", "salt").select("doc_id", "text")
    schema = _chunk_schema(docs.schema[doc_id].dataType)
    made = ordered.mapInArrow(lambda batches: _chunks(batches, path, end_id, block_ids, bits), schema)
    chunks = _uncompressed(made, "id_chunks")

    heads = chunks.select(
        "file", "chunk", "first", "n_ids", F.transform("planes", F.octet_length).alias("plane_bytes"),
        F.size("docs").alias("n_docs"),
    )
    starts = _starts(heads.groupBy("file").agg(F.sum("n_ids").alias("n")))
    placed = heads.join(F.broadcast(starts) if files <= BROADCAST_FILES else starts, "file")
    index = placed.select(
        "file", "chunk", (F.col("file_start") + F.col("first")).alias("start"), "n_ids", "plane_bytes", "n_docs",
        "file_start",
    )
    return IdFiles(chunks, stored(index, "id_index"), bits, files)


def _uncompressed(df: DataFrame, name: str) -> DataFrame:
    path = shared_folder(df.sparkSession, name)
    df.write.option("compression", "none").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _block(chunk: dict, bits: bool) -> bytes:
    """The ids of a chunk; ``ValueError`` if they aren't those that were written."""
    open_ = zstandard.ZstdDecompressor().decompress
    data = from_planes([open_(p) for p in chunk["planes"]], chunk["n_ids"], bits).tobytes()
    if zlib.crc32(data) != chunk["crc32"]:
        raise ValueError(f"chunk {chunk['chunk']} of file {chunk['file']} is damaged")
    return data


def _documents(batches: Iterator[pa.RecordBatch], bits: bool, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Documents from the chunks of files, chunk after chunk."""
    columns = ["doc_id", "start", "n_tokens", "ids"]
    kinds = pa.schema(list(zip(columns, (kind, pa.int64(), pa.int64(), pa.binary()), strict=True)))
    data, docs, file, done = bytearray(), [], None, []
    start = size = 0
    for batch in batches:
        for k in range(batch.num_rows):
            chunk = batch.slice(k, 1).to_pylist()[0]
            if chunk["file"] != file:
                file, start = chunk["file"], chunk["file_start"]
            data += _block(chunk, bits)
            docs += chunk["docs"]
            used = at = 0
            for doc in docs:
                n = doc["n_tokens"]
                if used + 4 * n > len(data):
                    break
                done.append((doc["doc_id"], start, n, bytes(data[used : used + 4 * n])))
                used, at, start, size = used + 4 * n, at + 1, start + n, size + 4 * n
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist([dict(zip(columns, d, strict=True)) for d in done], kinds)
                    done, size = [], 0
            del data[:used], docs[:at]
    if data or docs:
        raise ValueError(f"file {file} ends inside a document")
    if done:
        yield pa.RecordBatch.from_pylist([dict(zip(columns, d, strict=True)) for d in done], kinds)


def read_documents(files: IdFiles) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of each document, from the files.

    ``start`` counts the ids of all documents before it, ``ids`` are packed. A file is read
    by one task, chunk after chunk; a document may reach over many of them.
    """
    kind = files.chunks.schema["docs"].dataType.elementType["doc_id"].dataType
    starts = files.index.where("chunk = 0").select("file", "file_start")
    placed = files.chunks.join(F.broadcast(starts) if files.files <= BROADCAST_FILES else starts, "file")
    in_order = placed.repartitionById(files.files, F.col("file")).sortWithinPartitions("file", "chunk")
    arrow, bits = to_arrow_type(kind), files.bits
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    return in_order.mapInArrow(lambda batches: _documents(batches, bits, arrow), schema)


def read_span(files: IdFiles, start: int, n: int) -> DataFrame:
    """``(start, ids)`` of the ids ``start`` to ``start + n - 1`` of the whole sequence.

    One row for each chunk that the span touches, found by the index; no other is opened.
    """
    touched = files.index.where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start))
    rows = files.chunks.drop("first", "n_ids", "docs").join(touched.select("file", "chunk", "start", "n_ids"), ["file", "chunk"])
    bits = files.bits

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.to_pylist():
                low, high = max(start, chunk["start"]), min(start + n, chunk["start"] + chunk["n_ids"])
                ids = _block(chunk, bits)[4 * (low - chunk["start"]) : 4 * (high - chunk["start"])]
                yield pa.RecordBatch.from_pydict({"start": pa.array([low], pa.int64()), "ids": pa.array([ids], pa.binary())})

    return rows.mapInArrow(cut, "start long, ids binary")

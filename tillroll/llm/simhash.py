"""SimHash near duplicates through an inverted index of byte positions with count filtering.

Two fingerprints of 64 bits that differ in at most ``d`` bits agree in at least ``8 - d`` of
their 8 bytes. The index has a posting list for each choice of ``8 - d`` positions and the
bytes there; a pair is in a common list exactly if its tally of shared positional bytes
reaches that minimum. So the tally is never written out for the pairs that miss it: lists of
single bytes would hold one fingerprint in 256 each and their pairs grow with the square of
the input, while a list of four bytes holds one in 2**32.

Lists are dealt over the tasks and read in order, one at a time. A short list is compared
pair by pair. In a long one, fingerprints are reached from one another: each is compared
only with those not reached yet, and an edge is given for each one reached. That keeps every
component whole with fewer edges than members, in memory for one list of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import columns_free_of, join_counted, rows_in, stored
from tillroll.llm.components import connected_components

WORDS_PER_SHINGLE = 4
SEED = 42
#: Fingerprints are linked at so many differing bits or fewer.
MAX_BITS = 4
#: Posting lists up to this length are compared pair by pair.
SHORT_LIST = 24


def fingerprint(data: bytes, shingle: int = WORDS_PER_SHINGLE, seed: int = SEED) -> bytes:
    """SimHash of a text in UTF-8, 8 bytes, highest bit first."""
    words = data.lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return digest(joined, seed)
    starts = [0, *accumulate([len(w) + 1 for w in words])]
    hashes = b"".join([digest(joined[a : b - 1], seed) for a, b in zip(starts, starts[shingle:])])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).view(np.uint64).reshape(-1, 8)
    # Eight counters of a byte each are added at once, for at most 255 hashes.
    counts = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0).view(np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(bits)).tobytes()


def add_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the SimHash of each whole text as a signed 64-bit number.

    A text is lower-cased in A-Z and split at ASCII white space; shingles are four words with
    repeats, fewer words are one shingle, and no word at all, as in a null or empty text, gives
    zero. A column already named so keeps its name and the new one gets ``_`` added.
    """
    (name,) = columns_free_of(docs, name)
    schema = T.StructType([*docs.schema, T.StructField(name, T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).cast(pa.string()).cast(pa.binary())
            prints = b"".join([fingerprint(t.as_py() or b"") for t in texts])
            column = pa.array(np.frombuffer(prints, ">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def position_choices(max_bits: int) -> list[tuple[int, ...]]:
    if not 0 <= max_bits < 8:
        raise ValueError("0 to 7 differing bits: from 8 on no byte need be shared")
    return list(combinations(range(8), 8 - max_bits))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` that join what may be linked.

    The components of these edges are those of all pairs that differ in at most ``max_bits``
    bits; in long posting lists an edge stands for more than one such pair.
    """
    choices = position_choices(max_bits)
    masks = [sum(0xFF << 8 * p for p in choice) for choice in choices]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    # For the positions at which a pair agrees: the first choice that holds nothing else.
    first_choice = np.full(256, -1, np.int64)
    for agree in range(256):
        at = [p for p in range(8) if agree >> p & 1]
        if len(at) >= 8 - max_bits:
            first_choice[agree] = choices.index(tuple(at[: 8 - max_bits]))
    entries = [
        F.struct(F.lit(c).cast("smallint").alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes"))
        for c, m in enumerate(signed)
    ]
    postings = prints.select("fp", F.explode(F.array(*entries)).alias("e")).select("e.choice", "e.bytes", "fp")
    lists = postings.repartition("choice", "bytes").sortWithinPartitions("choice", "bytes", "fp")

    def close(x: np.ndarray) -> np.ndarray:
        return np.bitwise_count(x.view(np.uint64)) <= max_bits

    def within(choice: np.ndarray, starts: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Edges of whole lists; ``starts`` has their beginnings and the end."""
        lengths = np.diff(starts)
        number = np.repeat(np.arange(len(lengths)), lengths)
        short = np.repeat(lengths <= SHORT_LIST, lengths)
        for gap in range(1, min(int(lengths.max(initial=0)), SHORT_LIST)):
            pair = np.flatnonzero(short[:-gap] & (number[:-gap] == number[gap:]))
            if not len(pair):
                break
            x = fp[pair] ^ fp[pair + gap]
            pair, x = pair[near := close(x)], x[near]
            agree = np.packbits(x.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little").ravel()
            pair = pair[first_choice[agree] == choice[pair]]  # a pair is in many lists: once is enough
            yield fp[pair + gap], fp[pair]
        for k in np.flatnonzero(lengths > SHORT_LIST):
            left = fp[starts[k] : starts[k + 1]]
            reached: list[int] = []
            while len(left):
                if reached:
                    at = reached.pop()
                else:
                    at, left = left[0], left[1:]
                near = close(left ^ at)
                new, left = left[near], left[~near]
                reached += new.tolist()
                yield new, np.full(len(new), at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(parts: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            choice, key, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
            new = np.flatnonzero((key[1:] != key[:-1]) | (choice[1:] != choice[:-1])) + 1
            for a, b in within(choice, np.concatenate(([0], new, [len(fp)])), fp):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        parts: list[list[np.ndarray]] = []
        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            if not len(now[0]):
                continue
            change = np.flatnonzero((now[1][1:] != now[1][:-1]) | (now[0][1:] != now[0][:-1]))
            if parts and (parts[-1][0][-1], parts[-1][1][-1]) != (now[0][0], now[1][0]):
                yield from edges(parts)
                parts = []
            if len(change):
                last = change[-1] + 1
                yield from edges([*parts, [x[:last] for x in now]])
                parts, now = [], [x[last:] for x in now]
            parts.append(now)
        if parts:
            yield from edges(parts)

    return lists.mapInArrow(run, "a long, b long")


def classes(marked: DataFrame, doc_id: str, fp: str, max_bits: int = MAX_BITS) -> DataFrame:
    """One row for each distinct fingerprint: ``fp``, ``copies`` (its rows), ``root`` and
    ``component_id``.

    ``root`` is the component's smallest fingerprint, ``component_id`` the smallest ``doc_id``
    of its rows, null if all are.
    """
    prints = marked.groupBy(F.col(fp).alias("fp")).agg(
        F.min(doc_id).alias("first_id"), F.count(F.lit(1)).alias("copies")
    )
    prints = stored(prints, "fingerprints")
    roots = connected_components(links(prints, max_bits))
    linked = prints.join(roots, prints["fp"] == roots["node"], "left")
    linked = stored(linked.select("fp", "first_id", "copies", F.coalesce("root", "fp").alias("root")), "linked")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    found = join_counted(linked, stored(least, "components"), "root", "members", rows_in(linked))
    return found.select("fp", "copies", "root", "component_id")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each row of ``docs``: its ``doc_id``, ``fingerprint`` and ``component_id``.

    Texts are linked if their fingerprints differ in at most four bits. Texts without words
    share the fingerprint zero and are linked like any other. Repeated rows stand for
    themselves; null ids count as the largest. An empty table gives an empty one; other
    columns are left out.
    """
    marked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = stored(add_fingerprint(marked).select("doc_id", F.col("fingerprint").alias("fp")), "marked")
    found = stored(classes(marked, "doc_id", "fp"), "classes")
    joined = join_counted(marked, found, "fp", "copies", rows_in(marked))
    return joined.select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component of near duplicates, all columns as they were.

    The row with the smallest ``doc_id`` stays (null is the largest); of several such rows,
    that whose text has the smallest hash, and one of rows that repeat both.
    """
    (mark,) = columns_free_of(docs, "text_hash")
    hashed = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    ids = hashed.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(mark).alias("mark"))
    ids = stored(add_fingerprint(ids).select("doc_id", "mark", F.col("fingerprint").alias("fp")), "marked")
    found = stored(classes(ids, "doc_id", "fp"), "classes")
    # The least row of each fingerprint first, so that a large class brings few rows.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("least")
    per_print = ids.groupBy("fp").agg(least).join(found.select("fp", "root"), "fp")
    stays = per_print.groupBy("root").agg(F.min("least").alias("least"))
    stays = stays.select(F.col("least.doc_id").alias("stay_id"), F.col("least.mark").alias("stay_mark")).distinct()
    kept = hashed.join(
        stays, hashed[doc_id].eqNullSafe(stays["stay_id"]) & (hashed[mark] == stays["stay_mark"]), "left_semi"
    )
    return kept.dropDuplicates([doc_id, mark]).select(*docs.columns)

"""How quality filters act on each other in every order: duplicates by tries, results by masks.

Each document gets a mask with one bit for each filter that it fails. Four filters look at
the text alone. The fifth, "identical to the text of a smaller id", looks at all documents:

1. A task puts whole texts into a radix trie, lot by lot, with the smallest id at each end.
   A text with a smaller id in its lot is a duplicate; only one row for each different text
   of a lot goes on, so a text with very many copies costs one row a lot.
2. These texts are parted by ranges whose bounds are prefixes, just as long as needed to part
   neighbours in the tries. The bounds are cuts of equal weight through the tries of all lots.
3. A task for each range puts its texts into a trie and tells which row has the least id. The
   texts come in order, so a full trie is done but for its last text, and the next one begins:
   a range may be of any size.

What each order of the filters keeps and removes follows from the counts of the masks.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tillroll.llm.text_trie import TEXT_OVERHEAD, TextTrie

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
#: Memory of a trie, and bytes of a range on the mean; a range is one task.
LOT_BYTES, RANGE_BYTES = 48_000_000, 32_000_000
#: Cuts for each range; beyond so many ranges they get larger instead.
CUTS, MOST_RANGES = 24, 65_536
#: Bytes of a cut. Texts with a longer common beginning are in one range, which holds it once.
CUT_BYTES = 16_384
ROWS_AT_ONCE = 20_000


@dataclass(frozen=True)
class Rules:
    """A document fails A with fewer words, B with a smaller and C with a larger share in
    percent, D with any of the symbols."""

    least_words: int = 200
    distinct_percent: int = 50
    capitals_percent: int = 3
    symbols: str = "#$%&*|"


class TextMask:
    """The bits of the filters A to D, from the UTF-8 bytes of a whole text."""

    capitals = bytes(range(ord("A"), ord("Z") + 1))
    following = bytes(range(0x80, 0xC0))

    def __init__(self, rules: Rules):
        self.rules = rules
        self.symbol = re.compile(b"[" + re.escape(rules.symbols.encode()) + b"]").search

    def __call__(self, text: bytes) -> int:
        rules = self.rules
        words = text.split()  # of bytes, at space and tab to carriage return only
        n = len(words)
        few = n < rules.least_words
        alike = 100 * len(set(words)) < rules.distinct_percent * n
        capitals = len(text) - len(text.translate(None, self.capitals))
        points = len(text) if text.isascii() else len(text.translate(None, self.following))
        loud = 100 * capitals > rules.capitals_percent * points
        return few | alike << 1 | loud << 2 | (self.symbol(text) is not None) << 3


def _lots(batches: Iterator[pa.RecordBatch], lot_bytes: int) -> Iterator[TextTrie]:
    """Rows ``(doc_id, part)`` at the ends of their texts, in tries that fit in memory."""
    trie = TextTrie()
    for batch in batches:
        for doc_id, part, text in zip(*batch.columns, strict=True):
            number = doc_id.as_py()
            trie.insert(text.as_py(), number, (number, part.as_py()))
            if trie.size > lot_bytes:
                yield trie
                trie = TextTrie()
    if trie.root.kids or trie.root.rows:
        yield trie


def _cuts(batches: Iterator[pa.RecordBatch], grain: int, lot_bytes: int) -> Iterator[pa.RecordBatch]:
    """Beginnings of texts, one for each ``grain`` bytes of different texts of a lot, in order."""
    for trie in _lots(batches, lot_bytes):
        cuts, until = [], None
        for _, text, shared in trie.ends():
            if until is None:  # not the same place in each lot
                until = zlib.crc32(text) % grain
            until -= len(text) + TEXT_OVERHEAD
            if until < 0:
                cuts.append((text[: min(shared + 1, CUT_BYTES)], -(until // grain)))
                until %= grain
        prefixes, weights = [c for c, _ in cuts], [w for _, w in cuts]
        yield pa.RecordBatch.from_arrays([pa.array(prefixes, pa.binary()), pa.array(weights, pa.int64())], names=["prefix", "weight"])


def _bounds(docs: DataFrame, range_bytes: int, lot_bytes: int) -> list[bytes]:
    """The prefixes at which ranges of about equal weight begin, but for the first range.

    The driver gets ``CUTS`` prefixes for each range, of at most ``CUT_BYTES``.
    """
    total = docs.agg(F.sum(F.octet_length("text").cast("long") + TEXT_OVERHEAD)).first()[0] or 0
    range_bytes = max(range_bytes, total // MOST_RANGES)
    grain = max(1, range_bytes // CUTS)
    found = docs.mapInArrow(lambda batches: _cuts(batches, grain, lot_bytes), "prefix binary, weight long")
    summed = found.groupBy("prefix").agg(F.sum("weight").alias("weight"))
    bounds, filled = [], 0
    for prefix, weight in sorted((bytes(p), w) for p, w in summed.collect()):
        if filled >= CUTS:
            bounds.append(prefix)
            filled = 0
        filled += weight
    return bounds


def _frame(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(columns, schema, strict=True)], schema=schema)


def _local(
    batches: Iterator[pa.RecordBatch], rules: Rules, bounds: list[bytes], schema: pa.Schema, lot_bytes: int
) -> Iterator[pa.RecordBatch]:
    """``(range, doc_id, part, mask, copies, text)``: the text only of rows whose id is the lot's least for it.

    Rows without text are settled; they are spread over the ranges, through which they pass.
    """
    mask_of, ranges, spread = TextMask(rules), len(bounds) + 1, 0
    for trie in _lots(batches, lot_bytes):
        rows, size = [], 0
        for node, text, _ in trie.ends():
            mask, place = mask_of(text), bisect.bisect_right(bounds, text)
            counts: dict[tuple, int] = {}
            for row in node.rows:
                counts[row] = counts.get(row, 0) + 1
            for (number, part), copies in counts.items():
                if number is not None and number == node.least:
                    rows.append((place, number, part, mask, copies, text))
                    size += len(text)
                else:
                    spread = (spread + 1) % ranges
                    rows.append((spread, number, part, mask | (0 if number is None else DUPLICATE), copies, None))
            if size > lot_bytes // 16 or len(rows) >= ROWS_AT_ONCE:
                yield _frame(rows, schema)
                rows, size = [], 0
        yield _frame(rows, schema)


def _flagged(trie: TextTrie, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The rows of a trie, with the bit of a duplicate for those that have not the least id."""
    rows = []
    for node, _, _ in trie.ends():
        rows += [(n, part, mask | (DUPLICATE if n > node.least else 0), copies) for n, part, mask, copies in node.rows]
        if len(rows) >= ROWS_AT_ONCE:
            yield _frame(rows, schema)
            rows = []
    yield _frame(rows, schema)


def _settled(batches: Iterator[pa.RecordBatch], schema: pa.Schema, lot_bytes: int) -> Iterator[pa.RecordBatch]:
    """``(doc_id, part, mask, copies)`` of a range, whose rows come in order of text and id.

    A text that goes on in the next trie takes its least id along, which came first.
    """
    trie, last, least = TextTrie(), None, None
    for batch in batches:
        known = batch.column(5).is_null()
        yield pa.RecordBatch.from_arrays([c.filter(known) for c in batch.columns[1:5]], schema=schema)
        for doc_id, part, mask, copies, text in zip(*batch.columns[1:], strict=True):
            if text.is_valid:
                number, data = doc_id.as_py(), text.as_py()
                if trie.size > lot_bytes:
                    yield from _flagged(trie, schema)
                    trie = TextTrie()
                if data != last:
                    last, least = data, number
                trie.insert(data, least, (number, part.as_py(), mask.as_py(), copies.as_py()))
    yield from _flagged(trie, schema)


def filter_masks(
    docs: DataFrame,
    rules: Rules = Rules(),
    text: str = "text",
    doc_id: str = "doc_id",
    part: str = "lang",
    range_bytes: int = RANGE_BYTES,
    lot_bytes: int = LOT_BYTES,
) -> DataFrame:
    """``(doc_id, part, mask, copies)``: which filters a document fails, bit 0 for A to bit 4 for E.

    A null text counts as empty, a null part as the empty string. A document fails E if a
    smaller id has the same text; rows that repeat an id and its text don't make each other
    fail. A null id is smaller than none and has none that is smaller. Rows that are equal in
    id, text and part may come as one row or several with ``copies`` that add up. Other columns
    are not read. An empty table gives no rows. A task holds a trie of about ``lot_bytes``,
    however many texts its range has.
    """
    column = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    part_column = F.coalesce(F.col(part).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), part_column.alias("part"), column.alias("text"))
    bounds = _bounds(rows, range_bytes, lot_bytes)

    kind = docs.schema[doc_id].dataType
    out = T.StructType([T.StructField("doc_id", kind), T.StructField("part", T.StringType()),
                        T.StructField("mask", T.IntegerType()), T.StructField("copies", T.LongType())])
    between = T.StructType([T.StructField("range", T.IntegerType()), *out, T.StructField("text", T.BinaryType())])
    arrow_out, arrow_between = to_arrow_schema(out), to_arrow_schema(between)
    local = rows.mapInArrow(lambda batches: _local(batches, rules, bounds, arrow_between, lot_bytes), between)
    parted = local.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("text", "doc_id")
    return parted.mapInArrow(lambda batches: _settled(batches, arrow_out, lot_bytes), out)


def order_steps() -> list[tuple[int, str, int, str, int, int, int, int]]:
    """``(mask, filter_order, step, letter, kept, removed, redundant, unique)`` of every mask and
    every place of every order; the last four are 0 or 1."""
    found = []
    for order in itertools.permutations(range(len(FILTERS))):
        earlier, name = 0, "".join(FILTERS[k] for k in order)
        for step, k in enumerate(order, 1):
            for mask in range(1 << len(FILTERS)):
                fails, before = mask >> k & 1, int(mask & earlier != 0)
                row = (int(not fails and not before), int(fails and not before), int(fails and before), int(mask == 1 << k))
                found.append((mask, name, step, FILTERS[k], *row))
            earlier |= 1 << k
    return found


def audit(spark: SparkSession, masks: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, with document counts in the part:

    ``kept`` after the step, ``removed`` by it, ``redundant`` (fail its filter, but are removed
    earlier), ``unique_fails`` (fail its filter only), ``good_lost`` and ``toxic_lost`` (removed
    here, with a label ``quality`` or ``toxic`` of 1), and ``shapley`` (what the step's filter
    removes, summed over all orders). Documents without a label, or with null ones, are neither
    good nor toxic; of several labels of an id one is enough. The masks are counted before they
    meet the labels, and before the orders: at most 32 counts of each part are multiplied out.
    """
    counted = masks.groupBy("doc_id", "part", "mask").agg(F.sum("copies").alias("n"))
    known = labels.where("doc_id is not null").groupBy("doc_id")
    known = known.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flagged = counted.join(known, "doc_id", "left")
    of_label = [F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")]
    totals = flagged.groupBy("part", "mask").agg(F.sum("n").alias("n"), *of_label)

    steps = spark.createDataFrame(
        order_steps(),
        "mask int, filter_order string, step int, letter string, kept int, removed int, redundant int, only int",
    )
    met = totals.join(F.broadcast(steps), "mask")  # steps: a fixed table of 19,200 rows
    sums = {"kept": "n * kept", "removed": "n * removed", "redundant": "n * redundant", "unique_fails": "n * only",
            "good_lost": "good * removed", "toxic_lost": "toxic * removed"}
    by_step = met.groupBy("part", "filter_order", "step", "letter").agg(*[F.sum(F.expr(e)).alias(c) for c, e in sums.items()])
    shapley = met.groupBy("part", "letter").agg(F.sum(F.expr("n * removed")).alias("shapley"))
    return by_step.join(shapley, ["part", "letter"]).drop("letter")

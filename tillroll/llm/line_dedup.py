"""Repeated runs of lines by a suffix array over line ids, built by prefix doubling.

A text is the sequence of its lines that hold a word. A run of lines is *long* if it has
``min_words`` words or more. Of every long run that occurs more than once, in one document or
in several, the first occurrence stays and the lines of the later ones are deleted.

1. Lines are reduced to ids. A line that occurs once is in no repeated run and goes.
2. The array is sorted by the first line, then by 2, 4, 8, ... lines: the rank of a suffix
   at twice the depth is that of the pair (own rank, rank of the suffix half the depth
   further on). A rank is the number of smaller suffixes, so ranks of equal prefixes are
   equal. Only prefixes that are repeated and lie within their text stay in the sort, and
   sorting ends at the depth that step 3 asks for.
3. The suffixes that share a prefix of ``n`` lines are an interval of the array with a
   longest common prefix of at least ``n``. It is named by the ranks of the prefix's first
   and last power-of-two part. Enough prefixes are asked for to cover every long repeated
   run: at each line the shortest long run that begins there, and the one that ends there.

Ranks are given by counts of distinct pairs, summed up before the shuffle, in blocks of the
order; no task gets all suffixes, nor all those of a frequent line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import columns_free_of, join_counted, rows_in, stored

MIN_WORDS = 50
#: Blocks of the order in which ranks are summed up.
BLOCKS = 4096
PLACE = ["doc", "p"]


def _doc(text: str, doc_id: str) -> Column:
    """Names and orders documents: by id, null last, then by a hash of the text."""
    return F.struct(
        F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("text")
    )


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1)


def line_ids(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """Stored ``(doc, p, line_no, words, h1, h2)``: the lines that hold a word."""

    def facts(line: Column, at: Column) -> Column:
        words = F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
        return F.struct(
            at.alias("line_no"), words.alias("words"), F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")
        )

    lines = F.filter(F.transform(_lines(text), facts), lambda x: x["words"] > 0)
    exploded = docs.select(_doc(text, doc_id).alias("doc"), F.posexplode(lines).alias("p", "line"))
    # Rows that repeat id and text are one document.
    return stored(exploded.select("doc", "p", "line.*").dropDuplicates(PLACE), "lines")


def ranked(classes: DataFrame, order: list[str]) -> DataFrame:
    """``classes`` with ``rank``: the ``n`` of all classes before it, by ``block`` and ``order``."""
    classes = stored(classes, "classes")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    blocks = classes.groupBy("block").agg(F.sum("n").alias("size"))
    blocks = blocks.select("block", F.sum("size").over(before.orderBy("block")).alias("earlier"))
    inside = F.coalesce(F.sum("n").over(before.partitionBy("block").orderBy(*order)), F.lit(0))
    placed = classes.withColumn("inside", inside).join(blocks, "block")
    rank = F.coalesce("earlier", F.lit(0)) + F.col("inside")
    return stored(placed.select(*order, "n", rank.alias("rank")), "ranks")


def first_ranks(lines: DataFrame) -> DataFrame:
    """Stored ``(doc, p, line_no, words, rank, n)`` of the lines that occur more than once."""
    classes = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shift = 64 - BLOCKS.bit_length() + 1
    ranks = ranked(classes.withColumn("block", F.shiftright("h1", shift)), ["h1", "h2"])
    known = join_counted(lines, ranks, ["h1", "h2"], "n", rows_in(lines))
    return stored(known.select(*PLACE, "line_no", "words", "rank", "n"), "suffixes")


def doubled(suffixes: DataFrame, depth: int, total: int) -> DataFrame:
    """The ranks at twice the depth, of prefixes that are repeated and within their text."""
    further = suffixes.select("doc", (F.col("p") - depth).alias("p"), F.col("rank").alias("next"))
    pairs = stored(suffixes.select(*PLACE, "rank", "n").join(further, PLACE), "pairs")
    classes = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n"), F.first("n").alias("before"))
    classes = classes.where("n > 1")
    # Within a frequent rank the next one spreads its classes over its share of the order.
    place = F.col("rank") + F.floor(F.col("before") * F.col("next") / F.lit(total))
    width = -(-total // BLOCKS)
    order = classes.select(
        F.col("rank").alias("r"), F.col("next").alias("s"), "n", F.floor(place / F.lit(width)).alias("block")
    )
    ranks = ranked(order, ["r", "s"])
    named = pairs.select(*PLACE, F.col("rank").alias("r"), F.col("next").alias("s"))
    return stored(join_counted(named, ranks, ["r", "s"], "n", total).select(*PLACE, "rank", "n"), "suffixes")


def asked_runs(suffixes: DataFrame, min_words: int) -> DataFrame:
    """Stored ``(doc, p, size, line_nos)``: at each line the shortest long runs of repeated
    lines that begin or end there."""
    by_place = Window.partitionBy("doc").orderBy("p")
    island = suffixes.withColumn("island", F.col("p") - F.row_number().over(by_place))
    along = Window.partitionBy("doc", "island").orderBy("p")
    own = F.struct("line_no", "words")

    def shortest(lines: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("words"), F.array().cast("array<int>").alias("line_nos"))
        return F.aggregate(
            lines,
            start,
            lambda run, line: F.when(run["words"] >= min_words, run).otherwise(
                F.struct(
                    (run["words"] + line["words"]).cast("long").alias("words"),
                    F.concat(run["line_nos"], F.array(line["line_no"])).alias("line_nos"),
                )
            ),
        )

    # Each line has a word, so no shortest run has more than ``min_words`` lines.
    ahead = F.collect_list(own).over(along.rowsBetween(0, min_words - 1))
    back = F.collect_list(own).over(along.rowsBetween(-(min_words - 1), 0))
    both = island.select(*PLACE, shortest(ahead).alias("ahead"), shortest(F.reverse(back)).alias("back"))
    begin = F.struct("p", F.col("ahead").alias("run"))
    end = F.struct((F.col("p") - F.size("back.line_nos") + 1).alias("p"), F.col("back").alias("run"))
    runs = both.select("doc", F.explode(F.array(begin, end)).alias("r")).where(F.col("r.run.words") >= min_words)
    runs = runs.select("doc", "r.p", F.size("r.run.line_nos").alias("size"), F.array_sort("r.run.line_nos").alias("line_nos"))
    return stored(runs.dropDuplicates([*PLACE, "size"]), "runs")


def later_copies(docs: DataFrame, text: str, doc_id: str, min_words: int) -> DataFrame:
    """``(doc, line_no)`` arrays: for each document with any, the lines to delete."""
    lines = line_ids(docs, text, doc_id)
    suffixes = first_ranks(lines)
    runs = asked_runs(suffixes, min_words)
    longest = runs.agg(F.max("size")).first()[0] or 0
    total, depth, copies = max(rows_in(suffixes), 1), 1, None
    while depth <= longest:
        own = runs.where((F.col("size") >= depth) & (F.col("size") < 2 * depth))
        tail = suffixes.select("doc", (F.col("p") + depth).alias("end"), F.col("rank").alias("tail"))
        own = own.withColumn("end", F.col("p") + F.col("size"))
        interval = own.join(suffixes.select(*PLACE, "rank"), PLACE).join(tail, ["doc", "end"])
        interval = interval.select(*PLACE, "line_nos", "size", "rank", "tail")
        copies = interval if copies is None else copies.unionByName(interval)
        if 2 * depth <= longest:
            suffixes = doubled(suffixes, depth, total)
        depth *= 2
    if copies is None:
        return runs.select("doc", "line_nos").limit(0)
    copies = stored(copies, "intervals")
    key = ["size", "rank", "tail"]
    firsts = copies.groupBy(*key).agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = join_counted(copies, stored(firsts, "firsts"), key, "n", rows_in(copies))
    again = again.where(F.struct(*PLACE) > F.col("first"))
    return again.groupBy("doc").agg(F.array_distinct(F.flatten(F.collect_set("line_nos"))).alias("line_nos"))


def drop_repeated_runs(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` and ``n_deleted`` added.

    Lines are parted by line feeds; words by ASCII white space. Lines without a word are
    never deleted and don't part a run. The first occurrence is the one in the document with
    the smallest id (null is the largest), of equal ids that whose text has the smallest
    hash, then the earlier in the text; a copy may overlap it. A null text stays null and an
    empty one empty, with one line. Rows that repeat id and text are one document and get the
    same answer. An empty table gives an empty one. Columns of ``docs`` named like the new
    ones keep their names and the new ones get ``_`` added.
    """
    names = columns_free_of(docs, "kept_text", "n_lines", "n_deleted", "doc_key", "deleted_lines", "all_lines")
    kept_text, n_lines, n_deleted, doc_key, deleted, every = names
    found = later_copies(docs, text, doc_id, min_words)
    found = found.select(F.col("doc").alias(doc_key), F.col("line_nos").alias(deleted))
    joined = docs.withColumn(doc_key, _doc(text, doc_id)).join(found, doc_key, "left")
    lines = _lines(text)
    stay = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(deleted))
    rest = F.array_join(F.transform(stay, lambda k: F.get(F.col(every), k)), "\n")
    result = joined.withColumn(every, F.when(F.col(deleted).isNotNull(), lines))
    return result.select(
        *docs.columns,
        F.when(F.col(deleted).isNull(), F.col(text).cast("string")).otherwise(rest).alias(kept_text),
        F.size(lines).cast("long").alias(n_lines),
        F.coalesce(F.size(deleted), F.lit(0)).cast("long").alias(n_deleted),
    )

"""Exact duplicates with a heavy-hitter split.

Each row is reduced to a digest once and stored. Spark's frequent-items aggregate, which is
Misra and Gries' summary, names every digest that more than one row in ``HOT_KEYS`` has, and
some others; counting these exactly leaves the frequent ones and their winners. There are at
most ``HOT_KEYS`` of them, whatever the input, so they are broadcast and their rows never
shuffled. The other digests have few rows each and are shuffled in the ordinary way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import HOT_KEYS, columns_free_of, rows_in, stored

#: The white space that doesn't count: space, tab, line feed, vertical tab, form feed, return.
WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")


def _order(points: str, doc_id: str, row: str) -> list[Column]:
    """The row that stays is the first: longest original, then smallest id (null last)."""
    return [F.col(points).desc(), F.col(doc_id).asc_nulls_last(), F.col(row)]


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Stored rows ``(row, doc_id, digest, points)``; ``row`` tells rows that are equal apart."""
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).alias("doc_id"),
            F.sha2(normalised(F.col(text)), 256).alias("digest"),
            F.length(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("points"),
        ),
        "digests",
    )


def heavy_winners(keyed: DataFrame, total: int) -> DataFrame:
    """Digest, winner and size of every group that has more than ``total / HOT_KEYS`` rows."""
    summary = keyed.stat.freqItems(["digest"], 1 / HOT_KEYS)
    candidates = summary.select(F.explode("digest_freqItems").alias("digest"))
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull(), "doc_id", "row")).alias("best")
    counted = (
        keyed.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(best, F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") * HOT_KEYS > total)
    )
    return counted.select(
        "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"
    )


def dedup_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row, dropped ones too.

    Texts are equal if they are once the six ASCII white-space characters are deleted; null
    counts as empty. Of equal texts the row with most code points stays, then the smallest
    ``doc_id`` (null is the largest), then one of the rows that repeat both. ``kept`` is true
    for exactly one row of a group. An empty table gives an empty one; columns of ``docs``
    beside the two are not looked at.
    """
    keyed = digests(docs, text, doc_id)
    heavy = stored(heavy_winners(keyed, rows_in(keyed)), "heavy")
    hot = keyed.join(F.broadcast(heavy), "digest")
    group = Window.partitionBy("digest")
    first = group.orderBy(*_order("points", "doc_id", "row"))
    rest = (
        keyed.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
        .withColumn("keep_id", F.first("doc_id").over(first))
        .withColumn("keep_row", F.first("row").over(first))
        .withColumn("group_size", F.count(F.lit(1)).over(group))
    )
    return hot.unionByName(rest).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, by the rule of ``dedup_report``, with all their columns.

    Rows of frequent digests that are not like the winner in length and id go where they
    are read. Of rows that repeat all three, one stays.
    """
    keyed = digests(docs, text, doc_id)
    heavy = heavy_winners(keyed, rows_in(keyed)).join(
        keyed.select(F.col("row").alias("keep_row"), F.col("points").alias("keep_points")), "keep_row"
    )
    heavy = stored(heavy.select("digest", "keep_id", "keep_points"), "heavy")
    digest, points, place = columns_free_of(docs, "digest", "points", "place")
    marked = docs.withColumn(digest, F.sha2(normalised(F.col(text)), 256)).withColumn(
        points, F.length(F.coalesce(F.col(text).cast("string"), F.lit("")))
    )
    names = heavy.select(*[F.col(c).alias(f"heavy_{c}") for c in heavy.columns])
    like_winner = (
        (marked[digest] == names["heavy_digest"])
        & (marked[points] == names["heavy_keep_points"])
        & marked[doc_id].eqNullSafe(names["heavy_keep_id"])
    )
    same = marked[digest] == names["heavy_digest"]
    # Equal rows are summed up before the shuffle, so not even a third of them is much.
    hot = marked.join(F.broadcast(names), like_winner, "left_semi").groupBy(digest)
    hot = hot.agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias("kept")).select("kept.*")
    first = Window.partitionBy(digest).orderBy(F.col(points).desc(), F.col(doc_id).asc_nulls_last())
    rest = marked.join(F.broadcast(names), same, "left_anti").withColumn(place, F.row_number().over(first))
    return rest.where(F.col(place) == 1).select(*docs.columns).unionByName(hot)

"""The corpus pipeline: five stages from raw documents to token ids.

Each stage is a function of ``(spark, docs, sf_dir)``. Its result is written as Parquet and
read again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from tillroll.llm.common import columns_free_of, stored, table
from tillroll.llm.queries import WORD_BPE


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.3 or more go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest original stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays."""
    return simhash.one_of_each(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are words of test items go; the others stay whole."""
    (n_words, spans) = columns_free_of(docs, "n_words", "spans")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    beyond = decontaminate.is_contaminated(decontaminate.share_hit(spans), F.col(n_words))
    return found.where(~beyond).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    found = bpe.round_trip(docs.select("doc_id", "text"), public_tokenizers.path(WORD_BPE))
    return found.select("doc_id", "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_duplicates),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_copies),
    ("bpe_encoding", encode),
]

#: The first stage is a learned model, which SQL cannot express; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: ``doc_id``, ``ids`` and ``decoded`` of what is kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

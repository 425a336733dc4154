"""Token counts of the sections of documents, by offsets of one encoding of the whole text.

A document is encoded once. Its tokens' character spans are joined with the spans of its
sections, both sorted, by binary search. A token with characters in more than one section
goes to one by a rule that the caller names, so counts add up to the document's tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.offsets import ByteBpe, byte_bpe, cut

#: A crossing token goes to the section of its first character; or to that with most of its
#: characters, the first of equals.
RULES = ("start", "majority")
#: Documents whose sections are given on at once.
DOCS_PER_BATCH = 128
#: The section of tokens that lie in no span.
OUTSIDE = -1


def line_spans(text: str) -> np.ndarray:
    """Spans of the lines of a text, each with its line feed; an empty text has one."""
    starts, at = [0], text.find("\n") + 1
    while 0 < at < len(text):
        starts.append(at)
        at = text.find("\n", at) + 1
    return np.array([starts, [*starts[1:], len(text)]], np.int64).T


def allocate(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether it crosses a boundary of sections."""
    first, last = cut(spans, starts, ends)
    owner = np.where(first <= last, first, OUTSIDE)
    crossing = first < last
    if rule == "majority":
        for k in np.flatnonzero(crossing):
            own = spans[first[k] : last[k] + 1]
            held = np.minimum(own[:, 1], ends[k]) - np.maximum(own[:, 0], starts[k])
            owner[k] = first[k] + int(held.argmax())
    elif rule == "start":
        pass  # the first section it has a character in
    else:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    return owner, crossing


def count_by_section(
    docs: DataFrame,
    path: str,
    pattern: str,
    rule: str = "majority",
    text: str = "text",
    doc_id: str = "doc_id",
    spans: str | None = None,
) -> DataFrame:
    """One row for each section of each row of ``docs``: ``doc_id``, ``section`` (from 0),
    ``start_char`` and ``end_char``, ``n_tokens``, ``n_crossing``.

    ``spans`` names a column of sorted spans ``array<struct<start, end>>`` in characters that
    don't overlap; without it the sections are the lines, each with its line feed.
    ``n_tokens`` are the tokens allocated to the section, ``n_crossing`` those of them that
    have characters in another. Tokens in no span are counted in a section -1 if there are
    any. A null or empty text has one empty section without tokens (none, if ``spans`` has
    none). Null ids and repeated rows are answered like others. An empty table gives an
    empty one; other columns are left out.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule!r} is none of {RULES}")
    id_field = T.StructField("doc_id", docs.schema[doc_id].dataType)
    names = ["section", "start_char", "end_char", "n_tokens", "n_crossing"]
    schema = T.StructType([id_field, *[T.StructField(n, T.LongType()) for n in names]])

    def sections(bpe: ByteBpe, value: str, given: list | None) -> np.ndarray:
        if spans is None:
            own = line_spans(value)
        else:
            own = np.array([[s["start"], s["end"]] for s in given or []], np.int64).reshape(-1, 2)
        ids, starts, ends = bpe.encode(value)
        if not len(own):
            rows = np.zeros((int(len(ids) > 0), 5), np.int64)
            rows[:, 0], rows[:, 2], rows[:, 3] = OUTSIDE, len(value), len(ids)
            return rows
        owner, crossing = allocate(own, starts, ends, rule)
        n = len(own)
        counts = np.bincount(owner + 1, minlength=n + 1)
        crossed = np.bincount(owner[crossing] + 1, minlength=n + 1)
        rows = np.empty((n, 5), np.int64)
        rows[:, 0], rows[:, 1:3], rows[:, 3], rows[:, 4] = np.arange(n), own, counts[1:], crossed[1:]
        if counts[0]:
            rows = np.vstack([rows, [OUTSIDE, 0, len(value), counts[0], crossed[0]]])
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_PER_BATCH):
                piece = batch.slice(at, DOCS_PER_BATCH)
                texts = piece.column(1).cast(pa.string()).to_pylist()
                given = piece.column(2).to_pylist() if spans else [None] * len(texts)
                found = [sections(bpe, t or "", g) for t, g in zip(texts, given, strict=True)]
                which = np.repeat(np.arange(len(found)), [len(f) for f in found])
                table = np.concatenate(found)
                columns = [piece.column(0).take(pa.array(which)), *[pa.array(np.ascontiguousarray(c)) for c in table.T]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text], *([docs[spans]] if spans else [])).mapInArrow(run, schema)

"""Token files against the tokenizers library, plane round trips, spans, odd rows and damage."""

from __future__ import annotations

import functools
import itertools
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_edges import ODD
from tillroll.llm import queries, token_files, word_texts

SMALL = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")


from_file = functools.cache(Tokenizer.from_file)


@pytest.fixture(scope="module")
def library():
    return from_file(WORD)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in queries.QUERIES["op12_token_files"](spark, SMALL).collect()}
    start = 0
    assert len(rows) == len(docs)
    for doc_id, text in sorted(docs):
        ids = np.array([*ids_of(library, text), 2], "<u4")
        assert tuple(rows[doc_id]) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'sSt TRE!# 7\t\n\x1c\x85\xa0́İΣß<|éÿ×÷ÀɏŉẞÅ"), st.characters(codec="utf-8"))))
def test_encoder_equals_the_library(text):
    ours = token_files.encoder(WORD)
    for case in (text, f"x {text}<|endoftext|>y"):
        ids, _ = ours.encode(pa.array([case]))
        assert list(ids) == ids_of(from_file(WORD), case)


def test_encoder_starts_its_tables_anew(monkeypatch, library):
    monkeypatch.setattr(word_texts, "KEPT_STRINGS", 3)
    texts = ["one two three four, fünf one two! " * 5, None, "one İstanbul ΣΑΣ \x01 e\u0301", "", "two ẞ one's ½ 12",
             "a<|endoftext|>b \x1cc\x85d\xa0e"] * 3
    ids, starts = token_files.LibraryEncoder(WORD).encode(pa.array(texts))
    assert [list(ids[a:b]) for a, b in itertools.pairwise(starts)] == [ids_of(library, t) for t in texts]


@pytest.mark.parametrize("bits", [False, True])
@given(ids=st.lists(st.integers(0, 2**32 - 1)))
def test_planes_round_trip(bits, ids):
    block = np.array(ids, "<u4")
    planes = token_files.to_planes(block, bits)
    assert list(token_files.from_planes(planes, len(ids), bits)) == ids
    assert len(planes) == -(-max(ids, default=0).bit_length() // (1 if bits else 8))


@pytest.mark.parametrize(("bits", "end_id", "block_ids"), [(False, 2, 64), (True, 2, 1000), (False, None, 7)])
def test_odd_rows(spark, library, bits, end_id, block_ids):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("file", "chunk", "start", "ids", "salt", "of_text", "n_tokens")])
    files = token_files.write_ids(docs, WORD, end_id, block_ids=block_ids, bits=bits, file_bytes=300_000)
    rows = token_files.read_documents(files).orderBy("start", F.length("ids"), "doc_id").collect()
    end = [] if end_id is None else [end_id]
    expected = sorted((i is not None, i or 0, [*ids_of(library, t), *end]) for i, t in ODD)
    got = sorted((r.doc_id is not None, r.doc_id or 0, list(np.frombuffer(r.ids, "<u4"))) for r in rows)
    assert got == expected and [r.n_tokens for r in rows] == [len(r.ids) // 4 for r in rows]
    at = 0
    for r in rows:  # gapless, ascending by id with null first
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in rows if r.n_tokens]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    whole = b"".join(r.ids for r in rows)
    index = files.index.orderBy("start").collect()
    assert [i.start for i in index if i.n_ids] == list(np.cumsum([0, *[i.n_ids for i in index if i.n_ids]])[:-1])
    assert all(i.n_ids <= block_ids for i in index) and sum(i.n_docs for i in index) == len(ODD)
    for low, n in ((0, 5), (at // 3, at // 2), (at - 2, 9), (at + 4, 3)):
        parts = sorted(token_files.read_span(files, low, n).collect())
        assert b"".join(p.ids for p in parts) == whole[4 * low : 4 * (low + n)]


def test_hot_id_is_split_over_files(spark):
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) doc_id", "'same words here' text")
    files = token_files.write_ids(docs, WORD, 2, file_bytes=4000)
    assert files.chunks.groupBy("file").agg(F.sum("n_ids").alias("n")).agg(F.max("n")).first()[0] < 3000
    read = token_files.read_documents(files)
    assert read.count() == 3000 and read.agg(F.max("start")).first()[0] == 2999 * 4


def test_empty_table_and_damage(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    files = token_files.write_ids(empty, WORD, 2)
    assert token_files.read_documents(files).count() == 0 and files.index.count() == 0
    assert token_files.read_span(files, 0, 5).count() == 0
    files = token_files.write_ids(spark.createDataFrame([(1, "a b")], empty.schema), WORD, 2)
    damaged = token_files.IdFiles(files.chunks.withColumn("crc32", F.col("crc32") + 1), files.index, files.bits, files.files)
    with pytest.raises(Exception, match="is damaged"):
        token_files.read_documents(damaged).collect()

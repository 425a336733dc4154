"""The stages against brute force on their own input."""

from __future__ import annotations

import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_queries import SPACES, simhash, tables
from tillroll.llm import toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Documents before each stage, and the last stage's rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, kept[-1], SMALL).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return kept


def texts_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == steps[0].columns for df in steps[:-1])
    for before, after in zip(steps[:-2], steps[1:-1], strict=True):
        assert after.exceptAll(before).count() == 0


def test_toxic_documents_go(spark, steps):
    model = toxicity.train(steps[0], spark.read.parquet(f"{SMALL}/labels.parquet"))
    wanted = {i for i, text in texts_of(steps[0]).items() if model.score((text or "").encode()) < 0.3}
    assert set(texts_of(steps[1])) == wanted


def test_one_of_equal_texts_stays(steps):
    groups = {}
    for i, text in texts_of(steps[1]).items():
        groups.setdefault(re.sub(SPACES, "", text or ""), []).append((-len(text or ""), i))
    assert set(texts_of(steps[2])) == {min(g)[1] for g in groups.values()}


def test_one_of_near_duplicates_stays(steps):
    prints = {i: simhash(text or "") for i, text in texts_of(steps[2]).items()}
    stays = set(texts_of(steps[3]))
    # Every one that went has a chain of links to a smaller one that stays, and none that stays has.
    for i in prints:
        reached, todo = {i}, [i]
        while todo:
            at = todo.pop()
            new = {j for j in prints if j not in reached and (prints[at] ^ prints[j]).bit_count() <= 4}
            reached |= new
            todo += new
        assert (i in stays) == (i == min(reached))


def test_benchmark_copies_go(steps):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for (text,) in tables(SMALL).execute("SELECT text FROM benchmark").fetchall():
        item = words(text)
        n = min(13, len(item))
        windows |= {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
    stays = set(texts_of(steps[4]))
    for i, text in texts_of(steps[3]).items():
        own = words(text)
        hit = set()
        for n in {len(w) for w in windows}:
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
        assert (i in stays) == (not hit or 20 * len(hit) < len(own))


def test_the_rest_is_encoded(steps):
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = texts_of(steps[4])
    rows = {r.doc_id: r for r in steps[5].collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        assert rows[i].ids == theirs.encode(text or "", add_special_tokens=False).ids
        assert rows[i].decoded == theirs.decode(rows[i].ids, skip_special_tokens=False)


def test_run_gives_the_last_stage(spark, steps):
    assert corpus_pipeline.run(spark, SMALL).exceptAll(steps[5]).count() == 0
    assert corpus_pipeline.run(spark, SMALL).count() == steps[5].count()


def test_odd_rows_pass_every_stage(spark):
    long = "word " * 30_000
    odd = [(1, None), (2, ""), (3, ""), (3, ""), (None, "a b"), (None, None), (4, long), (5, long)]
    odd = [(i and 1_000_000 + i, text) for i, text in odd]  # ids without a label
    docs = spark.createDataFrame(odd, "doc_id long, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("x").alias("source"), F.lit(0).cast("long").alias("n_chars"),
        F.lit("kept").alias("score"), F.lit("too").alias("digest"), F.lit(1).alias("fingerprint"), F.lit(2).alias("n_words"))
    for docs_now in (docs, docs.where("false")):
        some = docs_now.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs_now = stage(spark, docs_now, SMALL).checkpoint()
            assert docs_now.columns == docs.columns
        left = docs_now.collect()
        assert len(left) == (3 if some else 0)
        assert corpus_pipeline.STAGES[-1][1](spark, docs_now, SMALL).count() == len(left)

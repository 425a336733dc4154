"""Registered queries against SQL on whole tables, and against brute force where SQL cannot."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from tests.compare import rows_of
from tests.conftest import SF_DIR
from tillroll.llm import queries as llm_queries
from tillroll.llm.oracle import ORACLE_SQL

SMALL = "/root/testdata/sf0.001"
SPACES = "[\x20\x09-\x0d]"


def tables(folder):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def texts():
    return dict(tables(SMALL).execute("SELECT doc_id, text FROM documents").fetchall())


def by_id(spark, name):
    return {row["doc_id"]: row for row in entry_module.queries()[name](spark, SMALL).collect()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    ours = llm_queries.QUERIES[name](spark, SF_DIR)
    theirs = tables(SF_DIR).execute(ORACLE_SQL[name])
    names = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    rows = ours.collect()
    assert rows and rows_of(ours.columns, rows) == rows_of(names, theirs.fetchall())


def test_toxicity_on_held_out_rows(spark):
    connection = tables("/root/testdata/sf0.1")
    labels = dict(connection.execute("SELECT doc_id, toxic FROM labels").fetchall())
    rows = llm_queries.QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.1").collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    seen = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(p and y for p, y in seen)
    assert right / sum(y for _, y in seen) > 0.8 and right / sum(p for p, _ in seen) > 0.9


def simhash(text: str) -> int:
    words = [w for w in re.split(f"{SPACES}+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    shingles = [" ".join(words[k : k + 4]) for k in range(max(len(words) - 3, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(spark, texts):
    prints = {i: simhash(t or "") for i, t in texts.items()}
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sorted(prints):
        for j in sorted(prints):
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    rows = by_id(spark, "op4_simhash")
    assert {i: r.fingerprint for i, r in rows.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in rows.items()} == {i: root(i) for i in prints}
    assert len({root(i) for i in prints}) < len(prints)


def test_sharding_keeps_its_law(spark, texts):
    rows = by_id(spark, "op5_sharding")
    assert rows.keys() == texts.keys()
    slots = defaultdict(list)
    for i, r in rows.items():
        data = (texts[i] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_token_counts_against_one_encoding_by_another_library(spark, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rows = defaultdict(list)
    for r in llm_queries.QUERIES["op7_token_counts"](spark, SMALL).collect():
        rows[r.doc_id].append(r)
    for i, text in texts.items():
        got = sorted(rows[i], key=lambda r: r.section)
        lines = (text or "").split("\n")
        lines = [line + "\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] or len(lines) == 1 else [])
        assert [r.end_char - r.start_char for r in got] == [len(line) for line in lines]
        assert sum(r.n_tokens for r in got) == len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_bpe_against_the_tokenizers_library(spark, texts):
    theirs = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, r in by_id(spark, "op9_bpe").items():
        ids = theirs.encode(texts[i] or "", add_special_tokens=False).ids
        packed = b"".join(n.to_bytes(4, "little") for n in ids)
        decoded = theirs.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_every_operator_has_a_query():
    numbers = Counter(int(re.match(r"op(\d+)_", name)[1]) for name in llm_queries.QUERIES)
    assert numbers == Counter(range(1, 14))
    assert set(ORACLE_SQL) < set(llm_queries.QUERIES)
    assert llm_queries.QUERIES.items() <= entry_module.queries().items() and "pipeline" in entry_module.queries()

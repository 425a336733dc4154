"""Nulls, empty texts and tables, ties, repeated rows and clashing column names; small laws."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm import (
    bpe,
    chat,
    common,
    components,
    decontaminate,
    exact_dedup,
    line_dedup,
    sharding,
    simhash,
    token_counts,
    toxicity,
    warc,
)

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = "lang wort " * 40_000
#: Null and empty values, ties, rows that repeat, a very long text.
ODD = [(1, None), (2, ""), (2, ""), (None, "a b c"), (None, None), (3, " \t\n"), (4, LONG), (5, LONG), (6, "A  b C")]
CLASHING = ["n_words", "spans", "items", "score", "fingerprint", "digest", "points", "place", "ids", "decoded", "shard",
            "slot", "record", "bucket", "key", "kept_text", "n_lines", "n_deleted", "doc", "text_hash"]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    return docs.select("*", *[F.lit(k).alias(name) for k, name in enumerate(CLASHING)])


def test_common_hot_keys(spark):
    left = common.stored(spark.range(5000).selectExpr("id", "if(id % 3 = 0, -1, id % 700) k"), "left")
    keys = common.stored(left.groupBy("k").count().withColumnRenamed("count", "n"), "keys")
    joined = common.join_counted(left, keys, "k", "n", 5000)
    assert joined.count() == 5000 and joined.where("k = -1").count() == 1667
    assert common.columns_free_of(left, "K", "x") == ["K_", "x"]


def test_decontamination(spark, odd):
    items = spark.createDataFrame([(1, "a b c"), (None, "x"), (2, None), (3, ""), (4, "wort lang wort")], "item_id long, text string")
    found = decontaminate.find_items(odd, items)
    assert found.columns == [*odd.columns, "n_words_", "spans_", "items_"]
    rows = Counter((r.doc_id, r.n_words_, tuple(r.items_), sum(s.words for s in r.spans_)) for r in found.collect())
    assert rows == Counter({
        (1, 0, (), 0): 1, (2, 0, (), 0): 2, (None, 3, ("1",), 3): 1, (None, 0, (), 0): 1, (3, 0, (), 0): 1,
        (4, 80_000, ("4",), 79_999): 1, (5, 80_000, ("4",), 79_999): 1, (6, 3, ("1",), 3): 1})
    assert decontaminate.find_items(odd, items.where("false")).where("size(items_) > 0").count() == 0
    assert decontaminate.find_items(odd.where("false"), items).count() == 0
    in_blocks = decontaminate.find_items(odd, items, block_words=3)
    assert in_blocks.select(*found.columns).exceptAll(found).count() == 0
    left = decontaminate.remove_spans(found, n_words="n_words_", spans="spans_")
    assert {r.doc_id for r in left.collect()} == {1, 2, None, 3}


def test_spans_are_cut_and_the_rest_stays(spark):
    item = " ".join(f"w{k}" for k in range(20))
    words = [f"x{k}" for k in range(500)]
    text = "Éa, " + ", ".join(words[:250]) + " -- " + item.upper() + "! " + ". ".join(words[250:])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = decontaminate.find_items(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert [r.doc_id for r in decontaminate.remove_spans(found, one_in=100).collect()] == []
    (row,) = decontaminate.remove_spans(found, one_in=20).collect()
    assert row.text == text.replace(item.upper(), "")


def test_automaton_against_all_windows():
    rng = random.Random(7)
    for trial in range(600):
        letters, window = ("ab", "abc")[trial % 2], rng.choice([2, 3, 4])
        text = lambda n: " ".join(rng.choice(letters) for _ in range(n)).encode()
        items = [(str(k), text(rng.randint(0, 8))) for k in range(rng.randint(0, 5))]
        doc = " ".join(rng.choice(letters + "z") for _ in range(rng.randint(0, 30))).encode()
        words, hit, named = doc.split(), set(), set()
        for name, data in items:
            own = data.split()
            n = min(window, len(own))
            for grams in {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else ():
                for k in range(len(words) - n + 1):
                    if tuple(words[k : k + n]) == grams:
                        hit |= set(range(k, k + n))
                        named.add(name)
        n_words, spans, found = decontaminate.match(decontaminate.build(items, window), doc, window)
        assert (n_words, found) == (len(words), named)
        assert [k for a, n in spans for k in range(a, a + n)] == sorted(hit)


def test_warc(spark):
    rows = [(5, "u", "same"), (3, "v\r\nX: y", "same"), (7, None, "same"), (9, "u", None), (8, "u", ""), (None, "u", "alone"), (1, "ü", "a\r\n\r\nb é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    for least, revisits in ((0, {5: "3", 7: "3", 9: "8"}), (1, {5: "3", 7: "3"}), (5, {})):
        archive = warc.write_archive(pages, least_bytes=least)
        assert archive.payloads.count() == 4
        got = {r.record_id: r for r in warc.read_pages(archive).collect()}
        assert len(got) == len(rows)
        assert {int(k): r.refers_to for k, r in got.items() if r.record_type == "revisit"} == revisits
        assert got["7"].payload_bytes == 4 and got["7"].payload_digest == got["3"].payload_digest
        assert got["9"].payload_bytes == 0 and got["1"].payload_bytes == 9
        records = {bytes(r.record) for r in warc.read_archive(archive).collect()}
        assert any(r.endswith("\r\n\r\na\r\n\r\nb é\r\n\r\n".encode()) for r in records)
        assert all(r.startswith(b"WARC/1.1\r\nWARC-Type: ") for r in records)
    assert warc.read_pages(warc.write_archive(pages.where("false"))).count() == 0


def test_toxicity_without_labels_or_documents(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (4, 0)], "doc_id long, toxic int")
    for known in (labels, labels.where("false")):
        model = toxicity.train(odd, known)
        rows = toxicity.add_score(odd, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score_ <= 1 for r in rows)
        assert len({r.score_ for r in rows if not (r.text or "").strip()}) == 1
        assert toxicity.add_score(odd.where("false"), model).count() == 0
    assert toxicity.train(odd.where("false"), labels) is not None
    assert not spark.createDataFrame([(None,)], "i long").select(toxicity.is_held_out(F.col("i"))).first()[0]


def test_label_model_finds_accuracies_and_a_dependence():
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.2
    fires = np.stack([rng.random(20_000) < np.where(y, a, b) for a, b in ((0.8, 0.1), (0.6, 0.05), (0.7, 0.2))], axis=1)
    votes = np.hstack([fires, fires[:, :1] ^ (rng.random((20_000, 1)) < 0.02)]).astype(np.int64)
    full = np.hstack([votes, np.ones((len(votes), 1))])
    model = None
    for _ in range(15):
        p = toxicity.posterior(model, votes, np.full(len(votes), -1))
        model = toxicity.fit_step(np.stack([full.T @ (full * w[:, None]) for w in (1 - p, p)]))
    assert model.parent[3] == 0 or model.parent[0] == 3
    assert abs(model.prior - 0.2) < 0.08
    assert np.mean((model.log_odds(votes) > 0) == y) > 0.88


def test_simhash(spark, odd):
    rows = Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect())
    assert rows == Counter({(1, 1): 1, (2, 1): 2, (None, 1): 1, (3, 1): 1, (None, 6): 1, (4, 4): 1, (5, 4): 1, (6, 6): 1})
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4, 6]
    assert simhash.near_duplicates(odd.where("false")).count() == 0
    nameless = odd.withColumn("doc_id", F.lit(None).cast("long"))
    assert simhash.one_of_each(nameless).count() == 3


def test_links_in_long_lists_keep_components(spark):
    rng = random.Random(11)
    prints = {rng.getrandbits(64) for _ in range(200)}
    for center in list(prints)[:20]:
        for _ in range(rng.choice([2, 80])):
            x = center
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    root = {r.node: r.root for r in components.connected_components(simhash.links(df)).collect()}
    todo, component = set(prints), {}
    while todo:
        seen, stack = set(), [todo.pop()]
        while stack:
            at = stack.pop()
            seen.add(at)
            near = {p for p in todo if (p ^ at).bit_count() <= 4}
            todo -= near
            stack += near
        component |= dict.fromkeys(seen, min(signed[p] for p in seen))
    assert all(root.get(s, s) == component[p] for p, s in signed.items())


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(7, 7), (100, 101), (101, 100)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {k: 0 for k in range(1, 41)} | {101: 100}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sharding(spark, odd):
    written = sharding.shuffled_shards(odd, shards=4, bucket_bytes=100_000)
    rows = written.collect()
    assert Counter((r.record.doc_id, r.record.text) for r in rows) == Counter(ODD)
    assert Counter(r.shard for r in rows) == Counter({0: 3, 1: 2, 2: 2, 3: 2})
    assert written.select("record.*").columns == odd.columns
    again = sharding.shuffled_shards(odd.repartition(5), shards=4, bucket_bytes=100_000).collect()
    order = lambda found: sorted((r.shard, r.slot, str(r.record)) for r in found)
    assert order(again) == order(rows)
    other = sharding.shuffled_shards(odd, shards=4, seed=1, bucket_bytes=100_000).collect()
    assert order(other) != order(rows)
    assert sharding.shuffled_shards(odd.where("false")).count() == 0
    assert sorted(r.slot for r in sharding.shuffled_shards(odd.limit(1)).collect()) == [0]


def test_sharding_of_rows_that_repeat(spark):
    copies = "if(id % 3 = 0, {}, {})"
    docs = spark.range(30_000).selectExpr(
        copies.format("7", "id") + " doc_id", copies.format("'the same text'", "concat('text ', id)") + " text",
        "if(id % 30 = 0, 1, 0) extra", "named_struct('n', array(1)) key")
    wanted = docs.groupBy(*docs.columns).count().collect()
    written = sharding.shuffled_shards(docs, shards=4, bucket_bytes=100_000)
    assert sorted(map(str, written.select("record.*").groupBy(*docs.columns).count().collect())) == sorted(map(str, wanted))
    slots = written.groupBy("shard").agg(F.count("*"), F.count_distinct("slot"), F.min("slot"), F.max("slot")).collect()
    assert sorted(tuple(r) for r in slots) == [(k, 7500, 7500, 0, 7499) for k in range(4)]
    same = written.where("record.doc_id = 7 and record.text = 'the same text'").groupBy("shard").count().collect()
    assert len(same) == 4 and all(2200 < r["count"] < 2800 for r in same)
    again = sharding.shuffled_shards(docs.repartition(5), shards=4, bucket_bytes=100_000)
    assert written.exceptAll(again).isEmpty() and again.exceptAll(written).isEmpty()

    rows = docs.select(F.struct("*").alias("record"), sharding.scatter_key(F.col("text"), F.col("doc_id"), 0).alias("key"),
                       F.lit(14).cast("long").alias("bytes"))
    keyed = rows.withColumn("bucket", F.pmod("key", F.lit(20)).cast("int"))
    repeated = sharding.repeated_keys(keyed, sharding._bucket_counts(keyed), 200_000)
    assert repeated.count() == 1
    sizes = sharding.spread(keyed, repeated, 20, 0).groupBy("bucket").count().collect()
    assert len(sizes) == 20 and all(1200 < r["count"] < 1800 for r in sizes)
    assert sharding.repeated_keys(keyed, sharding._bucket_counts(keyed), 2_000_000).isEmpty()


def test_exact_dedup(spark, odd):
    rows = exact_dedup.dedup_report(odd).collect()
    assert len(rows) == len(ODD) and sum(r.kept for r in rows) == 4
    empty = [r for r in rows if r.group_size == 5]
    assert len(empty) == 5 and {r.keep_id for r in empty} == {3}
    assert {(r.doc_id, r.keep_id) for r in rows if r.group_size == 2} == {(4, 4), (5, 4)}
    assert exact_dedup.drop_duplicates(odd).columns == odd.columns
    assert sorted(r.doc_id or 0 for r in exact_dedup.drop_duplicates(odd).collect()) == [0, 3, 4, 6]
    for df in (exact_dedup.dedup_report(odd.where("false")), exact_dedup.drop_duplicates(odd.where("false"))):
        assert df.count() == 0


def test_exact_dedup_of_frequent_and_rare_digests(spark):
    docs = spark.range(6000).selectExpr(
        "id doc_id", "if(id % 3 = 0, repeat(' ', cast(id % 5 as int)), concat('t', id div 4)) text", "id lang")
    groups: dict = {}
    for r in docs.collect():
        groups.setdefault(re.sub(r"\s", "", r.text), []).append((-len(r.text), r.doc_id))
    keep = {min(g)[1] for g in groups.values()}
    rows = exact_dedup.dedup_report(docs).collect()
    assert {r.doc_id for r in rows if r.kept} == keep and max(r.group_size for r in rows) == 2000
    assert {r.doc_id for r in exact_dedup.drop_duplicates(docs).collect()} == keep
    same = docs.selectExpr("1L doc_id", "'x' text", "2 lang")
    assert exact_dedup.drop_duplicates(same).count() == 1
    assert exact_dedup.dedup_report(same).where("kept").count() == 1


def test_token_counts(spark, odd):
    rows = token_counts.count_by_section(odd, BYTE, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) + 1 - 1  # " \t\n" is one line
    assert {r.n_tokens for r in rows if r.start_char == r.end_char} == {0}
    given = spark.createDataFrame([(1, "Grüße 🙂 abc", [(0, 3), (3, 5), (9, 11)])], "doc_id long, text string, at array<struct<start:int,end:int>>")
    for rule in token_counts.RULES:
        rows = token_counts.count_by_section(given, BYTE, public_tokenizers.PATTERN, rule, spans="at").collect()
        total = token_counts.count_by_section(given, BYTE, public_tokenizers.PATTERN, rule).first().n_tokens
        assert sum(r.n_tokens for r in rows) == total and {r.section for r in rows} == {-1, 0, 1, 2}
    assert token_counts.count_by_section(odd.where("false"), BYTE, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError, match="rule"):
        token_counts.count_by_section(odd, BYTE, public_tokenizers.PATTERN, "none")


def test_allocation_rules():
    spans = np.array([[0, 3], [3, 4], [4, 10]])
    starts, ends = np.array([0, 2, 2, 9, 12]), np.array([2, 4, 9, 10, 13])
    owner, crossing = token_counts.allocate(spans, starts, ends, "start")
    assert owner.tolist() == [0, 0, 0, 2, -1] and crossing.tolist() == [False, True, True, False, False]
    assert token_counts.allocate(spans, starts, ends, "majority")[0].tolist() == [0, 0, 2, 2, -1]


def test_chat(spark):
    hard = [r"\### Assistant: </turn> ok", "", "\\", "\\\\", "### ", "####", " </turn>\n", "é🙂 \n", None, ": x", "</turn></turn>"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hard)]
    rows += [(2, None, "assistant", "b"), (2, 1, "as:si\\stant", "c"), (2, 1, None, "a"), (None, 0, "assistant", "n"), (3, 0, "user", ""), (3, 0, "user", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    made = chat.format_conversations(df, BYTE, public_tokenizers.PATTERN)
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [(r, t or "") for _, _, r, t in rows[: len(hard)]]
    assert back[1].loss_text == "".join(t or "" for t in hard[1::2])
    assert [(t.role, t.text) for t in back[2].turns] == [("assistant", "b"), ("", "a"), ("as:si\\stant", "c")]
    assert back[None].loss_text == "n" and back[3].loss_text == "" and len(back[3].turns) == 2
    for r in made.collect():
        assert len(r.ids) == len(r.starts) == len(r.ends) == len(r.loss_mask)
        for a, b, masked in zip(r.starts, r.ends, r.loss_mask, strict=True):
            assert masked == any(t.loss and a < t.end and b > t.start and t.end > t.start for t in r.turns)
    assert chat.read_back(chat.format_conversations(df.where("false"), BYTE, public_tokenizers.PATTERN)).count() == 0
    with pytest.raises(ValueError, match="no turn"):
        chat.parse("something else")


def test_bpe(spark, odd):
    theirs = Tokenizer.from_file(WORD)
    rng = random.Random(5)
    texts = ["", " ", "a\x1cb İstanbul ΣΑΣ ǅ don't WE'LL 1234 !!!!", "<|endoftext|>x<|startoftext|> <|x|>", "aaaa " * 30, "a" * 3000, "é ́a  　x", "你好🙂"]
    texts += ["".join(rng.choice("aabbehtinors '.é9") for _ in range(200)) for _ in range(200)]
    own, labels = bpe.tokenizer(WORD), bpe.arc_labels(WORD)
    for text in texts:
        ids = own.encode(text).tolist()
        assert ids == theirs.encode(text, add_special_tokens=False).ids
        assert bpe.decode(labels, ids) == theirs.decode(ids, skip_special_tokens=False)
    encoded = bpe.encode_texts(odd, WORD)
    assert encoded.columns == [*odd.columns, "ids_"]
    decoded = bpe.decode_ids(encoded, WORD, ids="ids_")
    rows = decoded.collect()
    assert len(rows) == len(ODD) and [len(r.ids_) for r in rows if not (r.text or "").strip()] == [0] * 5
    assert all(r.decoded_ == bpe.decode(labels, r.ids_) for r in rows)
    assert bpe.decode_ids(bpe.encode_texts(odd.where("false"), WORD), WORD, ids="ids_").count() == 0


def test_line_dedup(spark, odd):
    rows = line_dedup.drop_repeated_runs(odd).collect()
    got = Counter((r.doc_id, r.n_lines_, r.n_deleted_, (r.kept_text_ or "")[:5]) for r in rows)
    assert got == Counter({
        (1, 1, 0, ""): 1, (2, 1, 0, ""): 2, (None, 1, 0, "a b c"): 1, (None, 1, 0, ""): 1, (3, 2, 0, " \t\n"): 1,
        (4, 1, 0, "lang "): 1, (5, 1, 1, ""): 1, (6, 1, 0, "A  b "): 1})
    assert [r.kept_text_ for r in rows if r.text is None] == [None, None]
    assert line_dedup.drop_repeated_runs(odd.where("false")).count() == 0


def test_runs_of_lines_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, "\n".join(rng.choice(["a", "b c", "d e f", "", "g"]) for _ in range(rng.randint(1, 14)))) for k in range(40)]
    rows += [(100 + k, rows[k][1] + "\nx y z") for k in range(5)]
    for words in (1, 5):
        seen, wanted = set(), {}
        for i, text in sorted(rows):
            lines = text.split("\n")
            full = [k for k, line in enumerate(lines) if line.split()]
            gone = set()
            runs = []
            for a in range(len(full)):
                for b in range(a, len(full)):
                    run = tuple(lines[k] for k in full[a : b + 1])
                    if sum(len(line.split()) for line in run) >= words:
                        runs.append((a, run, full[a : b + 1]))
            for _, run, at in sorted(runs, key=lambda r: r[0]):
                if run in seen:
                    gone |= set(at)
                seen.add(run)
            wanted[i] = "\n".join(line for k, line in enumerate(lines) if k not in gone)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.kept_text for r in line_dedup.drop_repeated_runs(df, min_words=words).collect()}
        assert got == wanted

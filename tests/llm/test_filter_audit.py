"""Tries against a dictionary of texts, masks and the audit against brute force, odd rows."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.test_edges import ODD
from tillroll.llm import filter_audit
from tillroll.llm.text_trie import TextTrie, shared_length

words_of = re.compile(r"[^\x20\x09-\x0D]+").findall


def mask_of(text: str) -> int:
    words = words_of(text)
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words),
             100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text))]
    return sum(f << k for k, f in enumerate(fails))


def masks_of(rows: list[tuple]) -> Counter:
    """``(doc_id, part, mask)`` of ``(doc_id, text, part)``, by looking at all texts at once."""
    least: dict[str, int] = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    return Counter(
        (i, part or "", mask_of(text or "") | (16 if i is not None and i > least[text or ""] else 0)) for i, text, part in rows
    )


def found(df) -> Counter:
    counts: Counter = Counter()
    for r in df.collect():
        counts[r.doc_id, r.part, r.mask] += r.copies
    return counts


@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(0, 9))))
def test_trie_holds_every_text_in_order(rows):
    trie = TextTrie()
    for text, number in rows:
        trie.insert(text, number, number)
    ends = list(trie.ends())
    assert [text for _, text, _ in ends] == sorted({t for t, _ in rows})
    before = b""
    for k, (node, text, shared) in enumerate(ends):
        numbers = [n for t, n in rows if t == text]
        assert node.rows == numbers and node.least == min(numbers)
        assert shared == (shared_length(before, text, 0) if k else 0)
        before = text


@given(st.text())
def test_text_masks(text):
    assert filter_audit.TextMask(filter_audit.Rules())(text.encode()) == mask_of(text)


def sample(n: int = 600) -> list[tuple]:
    """A third are copies of one text, a third have a long beginning in common."""
    draw, rows = random.Random(5), []
    for k in range(n):
        words = draw.choices(["one", "Two", "three#", "four\t", "fünf", "Ä"], k=draw.randint(0, 400))
        text = ["x " * 3000, "common " * 1500 + " ".join(words), " ".join(words)][k % 3]
        rows.append((draw.randint(0, n), text, draw.choice(["en", "fr", None, ""])))
    return rows


@pytest.mark.parametrize(("range_bytes", "lot_bytes"), [(filter_audit.RANGE_BYTES, 400_000), (20_000, 400_000), (200_000, 1)])
def test_masks_against_brute_force(spark, range_bytes, lot_bytes):
    rows = sample()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    docs = docs.select("*", *[F.lit(1).alias(c) for c in ("mask", "copies", "part", "range", "prefix")])
    assert found(filter_audit.filter_masks(docs, range_bytes=range_bytes, lot_bytes=lot_bytes)) == masks_of(rows)


def test_ranges_are_cut_below_common_beginnings(spark):
    docs = spark.createDataFrame([(r[0], "", r[1].encode()) for r in sample()], "doc_id long, part string, text binary")
    bounds = filter_audit._bounds(docs, 60_000, filter_audit.LOT_BYTES)
    texts = sorted({bytes(r.text) for r in docs.collect()})
    assert bounds == sorted(set(bounds)) and len(bounds) > 10
    assert sum(b.startswith(b"common " * 1500) for b in bounds) > 10
    sizes = [sum(len(t) for t in texts if lo <= t < hi) for lo, hi in itertools.pairwise([b"", *bounds, b"\xff"])]
    assert max(sizes) < 60_000 * 3


def test_audit_against_brute_force(spark):
    rows = sample(90) + [(i, t, "odd") for i, t in ODD]
    labels = [(k, k % 2, k % 3 == 0 and 1 or 0) for k in range(0, 90, 2)] + [(None, 1, 1), (4, None, None), (4, 1, 1), (5, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels_df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(spark, filter_audit.filter_masks(docs), labels_df).collect()}
    good, toxic = ({i for i, *of in labels if of[k] == 1 and i is not None} for k in (0, 1))
    masks, parts = list(masks_of(rows).elements()), {p or "" for *_, p in rows}
    shapley: Counter = Counter()
    expected = {}
    for part, order in itertools.product(parts, map("".join, itertools.permutations("ABCDE"))):
        left, gone = [(i, m) for i, p, m in masks if p == part], []
        for step, letter in enumerate(order, 1):
            bit = 1 << "ABCDE".index(letter)
            here = [(i, m) for i, m in left if m & bit]
            left = [(i, m) for i, m in left if not m & bit]
            expected[part, order, step] = (
                len(left), len(here), sum(bool(m & bit) for _, m in gone), sum(p == part and m == bit for _, p, m in masks),
                sum(i in good for i, _ in here), sum(i in toxic for i, _ in here))
            gone += here
            shapley[part, letter] += len(here)
    assert got.keys() == expected.keys() and len(got) == 600 * len(parts)
    for (part, order, step), counts in expected.items():
        r = got[part, order, step]
        assert (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost) == counts
        assert r.shapley == shapley[part, order[step - 1]]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    masks = filter_audit.filter_masks(docs)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert masks.count() == 0 and filter_audit.audit(spark, masks, labels).count() == 0

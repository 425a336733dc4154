"""The automaton's ids of odd texts against the tokenizers library."""

from __future__ import annotations

import functools
import itertools
import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm import bpe, word_texts

WORD = public_tokenizers.path("word_bpe_49k.json")
library = functools.cache(Tokenizer.from_file)


def ids_of(text):
    return library(WORD).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab'sSt TRE!# 7\t\n\x1c\x85\xa0́İΣß<|éÿ×÷ÀɏŉẞÅ"), st.characters(codec="utf-8"))))
def test_any_text(text):
    for case in (text, f"x {text}<|endoftext|>y"):
        assert bpe.tokenizer(WORD).encode(case).tolist() == ids_of(case)


def test_letters_of_other_unicode_versions():
    points = [c for c in range(0x250, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}b" for c in random.Random(3).sample(points, 8000)]
    ids, starts = bpe.tokenizer(WORD).encode_all(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in itertools.pairwise(starts)] == [ids_of(t) for t in texts]


def test_tables_start_anew(monkeypatch):
    monkeypatch.setattr(word_texts, "KEPT_STRINGS", 3)
    monkeypatch.setattr(bpe, "KEPT_ARCS", 3)
    texts = ["one two three four, fünf one two! " * 5, None, "<|endoftext|>", "", "<|startoftext|>a<|endoftext|><|endoftext|> b"] * 3
    own = bpe.WordBpe(WORD)
    for _ in range(2):
        ids, starts = own.encode_all(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in itertools.pairwise(starts)] == [ids_of(t) for t in texts]


def test_file_of_another_kind():
    with pytest.raises((ValueError, KeyError, TypeError)):
        bpe.WordBpe(public_tokenizers.path("byte_bpe_50k.json"))

"""Token ids of many whole texts at once, from the tokens of each different word.

What a tokenizer of the ``tokenizers`` library does before its model: normalisation (NFC, white
space to one space, lower case by character), words by the pattern in its file, and bytes to
letters. The tokenizer drops white space, and neither its normalisation nor its words reach over
it, so a text's ids are those of its chunks one after the other. Texts are cut into chunks, and
printable ASCII chunks into words, by Arrow. Latin chunks are cut by the same pattern; others go
through the library's normaliser, many at once, and its splitter, so that characters which
other tables of Unicode don't know are treated alike.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Different chunks and words of text that a worker keeps in each of two generations.
KEPT_STRINGS = 120_000
#: White space beyond ASCII; the tokenizer's words in lower-case ASCII, and in it
#: and Latin letters from sharp s on.
ODD_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
ASCII_WORDS = "('s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+)"
LATIN = re.compile("[!-~ß-öø-ɏ]+").fullmatch
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^a-z0-9ß-öø-ɏ]+").findall


def byte_symbols() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    made = array("I", ids)
    if sys.byteorder == "big":
        made.byteswap()
    return made.tobytes()


class Kept:
    """What was made lately, by key: two generations, of which the older one goes when the
    younger is full. Keys that come again move to the younger."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: list[str]) -> set[str]:
        """Those that have to be made; after this all others are in ``young``."""
        if len(self.young) >= KEPT_STRINGS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        lacking = {k for k in keys if k not in young}
        again = {k: old[k] for k in lacking if k in old}
        young.update(again)
        return lacking.difference(again)


class TextEncoder:
    """Ids of whole texts by a tokenizer's file and a function from a word to its tokens.

    The function gets a word in the letters that stand for its bytes, once as long as the word
    is kept.
    """

    def __init__(self, spec: dict, tokens_of: Callable[[str], list[int]]):
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        parts = [p["type"] for p in spec["pre_tokenizer"]["pretokenizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or parts != ["Split", "ByteLevel"]:
            raise ValueError(f"not a tokenizer of this kind: {kinds}, {parts}")
        # The rules before the model; its vocabulary isn't needed for them.
        rules = spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []}
        rules = Tokenizer.from_str(json.dumps(rules))
        self.normalize, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self.tokens_of = tokens_of
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.parts = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.letters = str.maketrans(dict(enumerate(byte_symbols())))
        self.by_chunk, self.by_word = Kept(), Kept()

    def _words(self, words: list[str]) -> list[bytes]:
        """Packed ids of words in the model's letters; the empty ones that cutting leaves have none."""
        known, tokens_of = self.by_word, self.tokens_of
        for word in known.missing(words):
            known.young[word] = packed(tokens_of(word)) if word else b""
        return list(map(known.young.__getitem__, words))

    def _ascii(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of printable ASCII chunks, and where each chunk's begin and the last one's end."""
        chunks = pc.ascii_lower(chunks)
        one_word = pc.ascii_is_alpha(chunks)
        rest = pc.replace_substring_regex(chunks.filter(pc.invert(one_word)), ASCII_WORDS, "\\1 ")
        parted = pc.split_pattern(pc.replace_with_mask(chunks, pc.invert(one_word), rest), " ")
        words = parted.values.dictionary_encode()
        values, firsts, lengths = in_a_row(self._words(strings(words.dictionary)))
        return gathered(values, firsts, lengths, words.indices.to_numpy(), parted.offsets.to_numpy())

    def _others(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of any chunks."""
        known = self.by_chunk
        new = list(known.missing(chunks))
        # White space beyond ASCII is still inside some of them.
        normal = [self.normalize(c) for c in new if ODD_SPACE(c)]
        plain = [c for c in new if not ODD_SPACE(c)]
        new = [c for c in new if ODD_SPACE(c)] + plain
        if plain:
            normal += self.normalize(" ".join(plain)).split(" ")
        if len(normal) != len(new):
            raise ValueError("the normaliser has changed the white space")
        words = list(map(self._in_words, normal))
        ids = iter(self._words([w for of_chunk in words for w in of_chunk]))
        for chunk, of_chunk in zip(new, words, strict=True):
            known.young[chunk] = b"".join(itertools.islice(ids, len(of_chunk)))
        return list(map(known.young.__getitem__, chunks))

    def _in_words(self, chunk: str) -> list[str]:
        """The words of a normalised chunk, in the model's letters, of which each is a byte."""
        if LATIN(chunk):
            letters = self.letters
            return [w.encode().decode("latin-1").translate(letters) for w in LATIN_WORDS(chunk)]
        return [word for word, _ in self.split(chunk)]

    def with_special(self, text: str) -> np.ndarray:
        """Ids of a text that has strings of special tokens, which become these tokens."""
        parts = self.parts(text)
        ids, starts = self.encode(pa.array(parts[::2], pa.string()))
        found = [ids[starts[0] : starts[1]]]
        for special, (a, b) in zip(parts[1::2], itertools.pairwise(starts[1:]), strict=True):
            found += [np.array([self.special[special]], "<u4"), ids[a:b]]
        return np.concatenate(found)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids begin and the last one's end.

        Null and empty texts have none.
        """
        special = functools.reduce(pc.or_, [pc.match_substring(texts, s) for s in self.special])
        chunks = pc.ascii_split_whitespace(pc.if_else(pc.fill_null(special, True), "", texts))
        found = chunks.values.dictionary_encode()
        plain = pc.and_(pc.string_is_ascii(found.dictionary), pc.ascii_is_printable(found.dictionary))
        values, starts = self._ascii(found.dictionary.filter(plain))
        more, firsts, lengths = in_a_row(self._others(strings(found.dictionary.filter(pc.invert(plain)))))
        is_plain = plain.to_numpy(zero_copy_only=False)
        all_firsts, all_lengths = np.empty(len(is_plain), np.int64), np.empty(len(is_plain), np.int64)
        all_firsts[is_plain], all_lengths[is_plain] = starts[:-1], np.diff(starts)
        all_firsts[~is_plain], all_lengths[~is_plain] = firsts + len(values), lengths
        values = np.concatenate([values, more])
        ids, starts = gathered(values, all_firsts, all_lengths, found.indices.to_numpy(), chunks.offsets.to_numpy())
        if pc.any(special).as_py():
            by_text = [ids[a:b] for a, b in itertools.pairwise(starts)]
            for k in np.flatnonzero(pc.fill_null(special, False).to_numpy(zero_copy_only=False)):
                by_text[k] = self.with_special(texts[int(k)].as_py())
            ids, starts = np.concatenate(by_text), np.cumsum([0, *map(len, by_text)])
        return ids, starts


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def in_a_row(made: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of some packed lists, and where each list's begin and how many they are."""
    lengths = np.fromiter(map(len, made), np.int64, len(made)) // 4
    return np.frombuffer(b"".join(made), "<u4"), np.cumsum(lengths) - lengths, lengths


def gathered(
    values: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, which: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the lists ``which``, and where in them those from each of the ``bounds`` on begin."""
    each = lengths[which]
    ends = np.concatenate([[0], np.cumsum(each)])
    places = np.arange(ends[-1]) + np.repeat(firsts[which] - ends[:-1], each)
    return values[places], ends[bounds]

"""BPE with word ends as a tokenization automaton: encode by transitions, decode by labels.

The automaton reads tokens. It starts as one state with a loop for each base symbol, and
each merge ``u v -> w`` puts a gadget into it:

* where an arc ``u`` is followed by an arc ``v``, an arc ``w`` is added beside the pair,
  to where ``v`` led;
* ``u`` now leads to a copy of its old target without the arc ``v``.

So the state after a token is the state of its right part when the token was made, less
the arcs cut since, and an arc ``b`` exists where that of its left part existed when ``b``
was made. Written out, the table has tokens squared entries; kept as the list of gadgets
(``born``, ``left``, ``right``, ``cut``) an arc is found in as many steps as the two tokens
have parts, and the arcs met are kept in a table.

A path of the automaton is the one correct tokenization of its symbols, and so is each
beginning of it. A word is therefore encoded from left to right along its arcs; a place
between two symbols is entered in one state only, so no place is entered twice.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.common import columns_free_of
from tillroll.llm.word_texts import TextEncoder

#: Arcs that were met and are kept; beyond it that table starts anew.
KEPT_ARCS = 400_000
#: Bytes of text that are encoded before a batch of rows is given on.
BATCH_BYTES = 2_000_000
#: Rows that are decoded before they are given on.
ROWS_AT_ONCE = 128


class Automaton:
    """The merge gadgets, put in one after the other, and a trie of arc labels."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        n = max(vocabulary.values()) + 1
        self.born, self.left, self.right = ([0] * n for _ in range(3))
        self.cut: dict[int, int] = {}
        self.arcs: dict[int, bool] = {}
        self.trie: dict = {}
        ending = {u: u.removesuffix("</w>") for u in vocabulary}
        bases = [t for t, bare in ending.items() if len(bare) == 1]
        for token in bases:
            self._label(token, vocabulary[token])
        for time, (u, v) in enumerate(merges, 1):
            self._gadget(time, vocabulary[u], vocabulary[v], vocabulary[u + v])
            self._label(u + v, vocabulary[u + v])

    def _gadget(self, time: int, u: int, v: int, w: int) -> None:
        self.born[w], self.left[w], self.right[w] = time, u, v
        self.cut[u << 32 | v] = time

    def _label(self, token: str, number: int) -> None:
        bare = token.removesuffix("</w>")
        symbols = [*bare[:-1], bare[-1] + "</w>"] if bare != token else [*bare]
        node = self.trie
        for s in symbols:
            node = node.setdefault(s, {})
        node[""] = number

    def arc(self, a: int, b: int) -> bool:
        """Does the state after ``a`` have an arc ``b``?"""
        known = self.arcs.get(a << 32 | b)
        if known is None:
            if len(self.arcs) >= KEPT_ARCS:
                self.arcs.clear()
            known = self.arcs[a << 32 | b] = self._arc(a, b)
        return known

    def _arc(self, a: int, b: int) -> bool:
        until = len(self.born) * 2  # gadgets put in before this time count
        while True:
            if self.cut.get(a << 32 | b, until) < until:
                return False
            born_a, born_b = self.born[a], self.born[b]
            if not born_a and not born_b:
                return True
            if born_b > born_a:
                # Of a pair x x -> b, the state after x has lost its arc x when b is added.
                if a == self.left[b] == self.right[b]:
                    return False
                b, until = self.left[b], born_b
            elif born_a > born_b:
                a, until = self.right[a], born_a
            else:
                a, b, until = self.right[a], self.left[b], born_b

    def _leaving(self, symbols: list[str], at: int) -> list[tuple[int, int]]:
        """Labels that the symbols from ``at`` on begin with, and where they end."""
        found, node, end = [], self.trie, at
        for symbol in symbols[at:]:
            if symbol not in node:
                break
            node, end = node[symbol], end + 1
            if "" in node:
                found.append((node[""], end))
        return found

    def encode(self, symbols: list[str]) -> list[int]:
        """The tokens of one word; its last symbol carries the word's end.

        Longest arcs are tried first. A place is entered once: whatever path reaches it
        holds the tokens of the symbols before it, so a second one would be the same.
        """
        n, arcs = len(symbols), self.arcs
        entered, tokens, open_arcs = bytearray(n + 1), [], [self._leaving(symbols, 0)]
        while open_arcs:
            here = open_arcs[-1]
            while here:
                token, end = here.pop()
                if entered[end]:
                    continue
                if tokens:
                    allowed = arcs.get(tokens[-1] << 32 | token)
                    if not (self.arc(tokens[-1], token) if allowed is None else allowed):
                        continue
                tokens.append(token)
                if end == n:
                    return tokens
                entered[end] = 1
                open_arcs.append(self._leaving(symbols, end))
                break
            else:
                open_arcs.pop()
                if tokens:
                    tokens.pop()
        raise ValueError(f"no path for {symbols}")


class WordBpe:
    """A tokenizer read from a file of the ``tokenizers`` library: BPE with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["end_of_word_suffix"] != "</w>" or spec["decoder"] is not None:
            raise ValueError("word ends marked </w> and no decoder are expected")
        self.automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]])
        self.texts = TextEncoder(spec, self._word)

    def _word(self, word: str) -> list[int]:
        return self.automaton.encode([*word[:-1], word[-1] + "</w>"])

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids begin and the
        last one's end; strings of special tokens become these tokens."""
        return self.texts.encode(texts)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text."""
        return self.encode_all(pa.array([text], pa.string()))[0]


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordBpe:
    """One automaton for each worker process."""
    return WordBpe(path)


@functools.lru_cache(maxsize=2)
def arc_labels(path: str) -> dict[int, str]:
    """The string of each token; all that decoding needs."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    labels = {number: token for token, number in spec["model"]["vocab"].items()}
    return labels | {t["id"]: t["content"] for t in spec["added_tokens"]}


def decode(labels: dict[int, str], ids: list[int]) -> str:
    """The labels of the arcs, with a space between, as the file names no decoder."""
    return " ".join([labels[i] for i in ids])


def in_pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``BATCH_BYTES`` of text, or of one row."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if column.type != pa.string():
            column = column.cast(pa.string())
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + BATCH_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _encoded(
    batches: Iterator[pa.RecordBatch], path: str, text: str, name: str, packed: bool
) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer(path)
    for batch in in_pieces(batches, text):
        column = batch.column(batch.schema.get_field_index(text))
        found, starts = bpe.encode_all(column if column.type == pa.string() else column.cast(pa.string()))
        if packed:
            offsets = pa.array(4 * starts, pa.int32()).buffers()[1]
            column = pa.Array.from_buffers(pa.binary(), len(batch), [None, offsets, pa.py_buffer(found)])
        else:
            column = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(found.view("<i4")))
        yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, ids: str, name: str) -> Iterator[pa.RecordBatch]:
    labels = arc_labels(path)
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            piece = batch.slice(at, ROWS_AT_ONCE)
            lists = id_lists(piece.column(piece.schema.get_field_index(ids)))
            texts = pa.array([decode(labels, x.tolist()) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*piece.columns, texts], names=[*piece.schema.names, name])


def _ids_field(name: str, packed: bool) -> T.StructField:
    return T.StructField(name, T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False), False)


def encode_texts(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", packed: bool = False) -> DataFrame:
    """``docs`` with the token ids of each whole text in a new column ``ids``.

    The ids are a list or, if ``packed``, little-endian unsigned 32-bit integers. Null and
    empty texts have none. All other columns are kept as they are; if one is named like
    ``ids``, the new column gets the name with ``_`` added. Repeated rows are each encoded.
    An empty table gives an empty one.
    """
    (name,) = columns_free_of(docs, ids)
    schema = T.StructType([*docs.schema, _ids_field(name, packed)])
    return docs.mapInArrow(lambda batches: _encoded(batches, path, text, name, packed), schema)


def id_lists(column: pa.Array) -> Iterator[np.ndarray]:
    """The ids of each row of an Arrow column of lists or packed ids; null has none."""
    valid = column.is_valid().to_pylist()
    if pa.types.is_binary(column.type):
        for value in column:
            yield np.frombuffer(value.as_py() or b"", "<u4")
        return
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for k, there in enumerate(valid):
        yield values[ends[k] : ends[k + 1]] if there else values[:0]


def decode_ids(encoded: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded text of each row's ids in a new column ``decoded``.

    Null decodes to the empty text. An id that the vocabulary lacks raises ``KeyError``.
    """
    (name,) = columns_free_of(encoded, decoded)
    schema = T.StructType([*encoded.schema, T.StructField(name, T.StringType(), False)])
    return encoded.mapInArrow(lambda batches: _decoded(batches, path, ids, name), schema)


def round_trip(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", packed: bool = False
) -> DataFrame:
    """``encode_texts`` and then ``decode_ids``, both in one pass and one worker per task."""
    ids_name, text_name = columns_free_of(docs, ids, decoded)
    schema = T.StructType([*docs.schema, _ids_field(ids_name, packed), T.StructField(text_name, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, path, text, ids_name, packed), path, ids_name, text_name)

    return docs.mapInArrow(run, schema)

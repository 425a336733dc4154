"""Benchmark decontamination with a generalised suffix automaton over the words of test items.

Items are a test set, not corpus data. They are cut into blocks of at most ``BLOCK_WORDS``
words; the items of a block are broadcast and each worker builds their automaton once, so what
is sent has a fixed bound, and more items mean more passes, not a larger automaton.
A document is read once for each block, word by word, and the automaton gives at every word
the longest run of words ending there that some item holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import columns_free_of, stored

#: A window is so many consecutive words of an item, or a whole item that has fewer.
WINDOW = 13
#: A document is contaminated from this share of hit words on: one in twenty.
ONE_IN = 20
#: Words of items in one automaton. It has at most twice as many states.
BLOCK_WORDS = 300_000

#: Bytes outside words become spaces, A-Z become a-z; all bytes of other letters stay.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

SPANS = T.ArrayType(
    T.StructType([T.StructField("first_word", T.IntegerType()), T.StructField("words", T.IntegerType())]), False
)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORD_BYTES).split()


@dataclass
class Automaton:
    """Suffix automaton of many items.

    ``window_state[s]`` holds the last ``window`` words of the matches of state ``s`` (-1:
    they are shorter), ``window_items`` the items with that window. ``short_state[s]`` is
    the nearest state, from ``s`` upwards by links, whose full match is a whole short item,
    ``short_items`` these items. ``least`` is the length of the shortest window.
    """

    vocabulary: dict[bytes, int]
    arcs: list[dict[int, int]]
    link: list[int]
    length: list[int]
    window_state: list[int]
    short_state: list[int]
    short_items: list[frozenset[str]]
    window_items: list[frozenset[str]]
    least: int


def build(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> Automaton:
    """The automaton of ``(item_id, text)`` pairs. Items without words are left out."""
    vocabulary: dict[bytes, int] = {}
    arcs: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def new_state(n: int, out: dict[int, int], to: int) -> int:
        arcs.append(out)
        length.append(n)
        link.append(to)
        return len(arcs) - 1

    def split(p: int, w: int, q: int) -> int:
        """The state of the matches of ``q`` that are one word longer than those of ``p``."""
        copy = new_state(length[p] + 1, dict(arcs[q]), link[q])
        link[q] = copy
        while p != -1 and arcs[p].get(w) == q:
            arcs[p][w] = copy
            p = link[p]
        return copy

    def extend(last: int, w: int) -> int:
        q = arcs[last].get(w)
        if q is not None:
            return q if length[q] == length[last] + 1 else split(last, w, q)
        new, p = new_state(length[last] + 1, {}, 0), last
        while p != -1 and w not in arcs[p]:
            arcs[p][w] = new
            p = link[p]
        if p != -1:
            q = arcs[p][w]
            link[new] = q if length[q] == length[p] + 1 else split(p, w, q)
        return new

    coded = []
    for item, text in items:
        codes = [vocabulary.setdefault(w, len(vocabulary)) for w in words_of(text)]
        if codes:
            coded.append((item, codes))
            last = 0
            for w in codes:
                last = extend(last, w)

    n = len(arcs)
    short_items: list[set[str]] = [set() for _ in range(n)]
    window_items: list[set[str]] = [set() for _ in range(n)]
    is_short = [False] * n
    by_length = sorted(range(1, n), key=length.__getitem__)
    # The state that holds the last ``window`` words of a match, for matches at least so long.
    window_state = [-1] * n
    for s in by_length:
        up = window_state[link[s]]
        window_state[s] = up if up != -1 else s if length[s] >= window else -1
    for item, codes in coded:
        state, name = 0, set() if item is None else {item}
        for k, w in enumerate(codes, 1):
            state = arcs[state][w]
            if k >= window:
                window_items[window_state[state]] |= name
        if len(codes) < window:
            is_short[state] = True
            short_items[state] |= name
    # The nearest state upwards, itself included, at whose full length a short item ends.
    short_state = [-1] * n
    for s in by_length:
        short_state[s] = s if is_short[s] else short_state[link[s]]
    return Automaton(
        vocabulary,
        arcs,
        link,
        length,
        window_state,
        short_state,
        [frozenset(x) for x in short_items],
        [frozenset(x) for x in window_items],
        min((min(len(c), window) for _, c in coded), default=0),
    )


def match(auto: Automaton, data: bytes, window: int = WINDOW) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words; hit spans as (first word, words), apart and in order; items that occur."""
    words = words_of(data)
    if not auto.least or len(words) < auto.least:
        return len(words), [], set()
    codes = np.array(list(map(auto.vocabulary.get, words, [-1] * len(words))), np.int64)
    # A word that no item has ends every match, so only long enough runs of known words are read.
    known = np.flatnonzero(np.diff(np.concatenate(([0], (codes >= 0).view(np.int8), [0]))))
    starts, ends = known[::2], known[1::2]
    long = ends - starts >= auto.least
    spans: list[tuple[int, int]] = []
    hit: set[str] = set()
    arcs, link, length = auto.arcs, auto.link, auto.length
    for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        state, matched = 0, 0
        for at, w in enumerate(codes[start:end].tolist(), start):
            while state and w not in arcs[state]:
                state = link[state]
                matched = length[state]
            to = arcs[state].get(w)
            if to is None:
                continue
            state, matched = to, matched + 1
            covered = 0
            if matched >= window:
                covered = window
                hit |= auto.window_items[auto.window_state[state]]
            short = auto.short_state[state]
            if short == state and matched < length[state]:
                short = auto.short_state[link[state]]
            if short != -1:
                covered = max(covered, length[short])
                while short != -1:
                    hit |= auto.short_items[short]
                    short = auto.short_state[link[short]] if link[short] != -1 else -1
            if covered:
                first = at - covered + 1
                while spans and spans[-1][0] + spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, at - first + 1))
    return len(words), spans, hit


def merged(*parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of several blocks as one list of spans that don't touch."""
    spans: list[tuple[int, int]] = []
    for first, n in sorted(s for part in parts for s in part):
        if spans and spans[-1][0] + spans[-1][1] >= first:
            first, end = spans[-1][0], max(sum(spans[-1]), first + n)
            spans[-1] = (first, end - first)
        else:
            spans.append((first, n))
    return spans


_last_built: dict[str, Automaton] = {}


def built_once(key: str, items: list[tuple[str | None, bytes]], window: int) -> Automaton:
    """The automaton of a block, built once by each worker process and not by each task."""
    if key not in _last_built:
        _last_built.clear()
        _last_built[key] = build(items, window)
    return _last_built[key]


def item_blocks(items: DataFrame, item_id: str, text: str, most: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in lists of at most ``most`` words (or one item), read one partition at a time."""
    block, size = [], 0
    rows = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("string").alias("text"))
    for row in rows.toLocalIterator():
        data = (row["text"] or "").encode()
        n = len(words_of(data))
        if block and size + n > most:
            yield block
            block, size = [], 0
        if n:
            block.append((row["item"], data))
            size += n
    if block:
        yield block


def find_items(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (hit words) and ``items`` (ids that occur, sorted).

    A window is ``window`` consecutive words of an item, or a whole item that has fewer. A
    word is hit if it lies in an occurrence of a window; spans are the maximal runs of hit
    words. A null or empty text has no words, an item without words no window, so an empty
    table of items hits nothing. Items with a null id hit words but are not named. Repeated
    rows are each answered. Columns of ``docs`` named like the new ones keep their names and
    the new ones get ``_`` added.
    """
    names = columns_free_of(docs, "n_words", "spans", "items")
    new = T.StructType(
        [
            T.StructField(names[0], T.LongType()),
            T.StructField(names[1], SPANS),
            T.StructField(names[2], T.ArrayType(T.StringType(), False)),
        ]
    )
    schema = T.StructType([*docs.schema, *new])
    span_type = pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32())]))
    context = docs.sparkSession.sparkContext

    def scan(frame: DataFrame, block: list[tuple[str | None, bytes]], again: bool) -> DataFrame:
        sent, key = context.broadcast(block), uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = built_once(key, sent.value, window)
            for batch in batches:
                old = batch.slice(0) if again else None
                counts, spans, found = [], [], []
                for k, t in enumerate(batch.column(batch.schema.get_field_index(text)).cast(pa.string()).to_pylist()):
                    n, s, hit = match(auto, (t or "").encode(), window)
                    if old is not None:
                        before = old.column(old.num_columns - 2)[k].as_py()
                        s = merged([(b["first_word"], b["words"]) for b in before], s)
                        hit |= set(old.column(old.num_columns - 1)[k].as_py())
                    counts.append(n)
                    spans.append([{"first_word": a, "words": b} for a, b in s])
                    found.append(sorted(hit))
                kept = batch.columns[: batch.num_columns - 3] if again else batch.columns
                columns = [pa.array(counts, pa.int64()), pa.array(spans, span_type), pa.array(found, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=schema.names)

        return frame.mapInArrow(run, schema)

    out, again = docs, False
    for block in item_blocks(items, item_id, item_text, block_words):
        out = scan(stored(out, "decontaminate") if again else out, block, again)
        again = True
    return out if again else scan(docs, [], False)


def share_hit(spans: str = "spans") -> F.Column:
    """Number of hit words."""
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, s: n + s["words"])


def is_contaminated(n_hit: F.Column, n_words: F.Column, one_in: int = ONE_IN) -> F.Column:
    return (n_hit > 0) & (n_hit * one_in >= n_words)


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given words and what stands between the words of a span."""
    data = text.encode()
    flags = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    parts, at = [], 0
    for first, n in spans:
        parts.append(data[at : starts[first]])
        at = ends[first + n - 1]
    return b"".join([*parts, data[at:]]).decode()


def remove_spans(
    found: DataFrame,
    text: str = "text",
    n_words: str = "n_words",
    spans: str = "spans",
    longest: int = WINDOW,
    one_in: int = ONE_IN,
) -> DataFrame:
    """Drop rows whose hit words reach the coverage limit; cut longer spans from the others.

    ``found`` comes from ``find_items``. Rows with at least one hit word in ``one_in`` words
    go. In the rows that stay, spans of ``longest`` words or more are cut from the text, and
    everything outside them stays as it is, byte for byte.
    """
    kept = found.where(~is_contaminated(share_hit(spans), F.col(n_words), one_in))
    schema = kept.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts = batch.column(at).to_pylist()
            for k, own in enumerate(batch.column(batch.schema.get_field_index(spans)).to_pylist()):
                cut = [(s["first_word"], s["words"]) for s in own if s["words"] >= longest]
                if cut:
                    texts[k] = cut_words(texts[k], cut)
            columns = [*batch.columns]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return kept.mapInArrow(run, schema)

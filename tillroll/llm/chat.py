"""Chat formatting with loss masks aligned by offsets.

A conversation is rendered as one text in a template that marks its turns, and encoded once.
The spans of the turns that carry loss and the spans of the tokens, both sorted, are
intersected by binary search. What is written can be read back: control strings inside
roles and texts are escaped, so the template's own ones stand out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.offsets import byte_bpe, cut

#: The template of a turn: begin, role, middle, text, end.
BEGIN, MIDDLE, END = "### ", ": ", " </turn>\n"
#: What is escaped by a backslash before it; a role's colons too.
IN_TEXT, IN_ROLE = re.compile(r"\\|###|</turn>"), re.compile(r"\\|###|</turn>|:")
ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]+|\\.|<(?!/turn>))*) </turn>\n", re.DOTALL)
LOSS_ROLES = ("assistant",)
ROWS_PER_BATCH = 256

FORMATTED = (
    "conv_id {id_type}, formatted string, turns array<struct<role:string,start:int,end:int,loss:boolean>>, "
    "ids array<int>, starts array<int>, ends array<int>, loss_mask array<boolean>"
)
TURNS = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("loss", pa.bool_())]))


def escape(text: str, what: re.Pattern[str] = IN_TEXT) -> str:
    return what.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], loss_roles: tuple[str, ...] = LOSS_ROLES) -> tuple[str, list[dict]]:
    """The text of a conversation, and each turn's span of escaped text in code points."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = BEGIN + escape(role, IN_ROLE) + MIDDLE, escape(text)
        start = at + len(head)
        spans.append({"role": role, "start": start, "end": start + len(body), "loss": role in loss_roles})
        parts += [head, body, END]
        at = start + len(body) + len(END)
    return "".join(parts), spans


def mask_tokens(spans: list[dict], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Is any character of the token in a span that carries loss?"""
    own = np.array([(s["start"], s["end"]) for s in spans if s["loss"] and s["end"] > s["start"]], np.int64).reshape(-1, 2)
    first, last = cut(own, starts, ends)
    return first <= last


def format_conversations(
    rows: DataFrame,
    path: str,
    pattern: str,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_roles: tuple[str, ...] = LOSS_ROLES,
) -> DataFrame:
    """One row for each conversation: its text, the spans of its turns, its tokens and mask.

    Rows are ordered by turn (null first), then role and text, and repeated rows stay. Null
    texts and roles are empty, and an empty text is a turn without loss. A null id is one
    conversation. ``starts`` and ``ends`` are the tokens' characters in ``formatted``, and
    ``loss_mask`` is true for a token with a character under loss. A token that also has
    characters outside, at an edge, counts as under loss; cutting its span at the turn's
    gives the characters alone. An empty table gives an empty one; other columns are left
    out. A conversation is one record, so it has to fit into one row.
    """
    turns = F.sort_array(
        F.collect_list(
            F.struct(
                F.col(turn).alias("turn"),
                F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
            )
        )
    )
    whole = rows.groupBy(F.col(conv_id).alias("conv_id")).agg(turns.alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                piece = batch.slice(at, ROWS_PER_BATCH)
                made = [render([(t["role"], t["text"]) for t in x], loss_roles) for x in piece.column(1).to_pylist()]
                tokens = [bpe.encode(formatted) for formatted, _ in made]
                masks = [mask_tokens(spans, s, e) for (_, spans), (_, s, e) in zip(made, tokens, strict=True)]
                offsets = pa.array(np.cumsum([0, *map(len, masks)]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x), kind))
                    for x, kind in (*((y, pa.int32()) for y in zip(*tokens, strict=True)), (masks, pa.bool_()))
                ]
                columns = [piece.column(0), pa.array([f for f, _ in made]), pa.array([s for _, s in made], TURNS), *lists]
                names = ["conv_id", "formatted", "turns", "ids", "starts", "ends", "loss_mask"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return whole.mapInArrow(run, FORMATTED.format(id_type=rows.schema[conv_id].dataType.simpleString()))


def parse(formatted: str) -> list[dict]:
    """Roles and texts from a formatted conversation; other text raises."""
    found, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        found.append({"role": unescape(m[1]), "text": unescape(m[2])})
        at = m.end()
    return found


def under_loss(formatted: str, spans: list[dict], starts: list[int], ends: list[int], mask: list[bool]) -> str:
    """The unescaped text that the masked tokens cover inside the turns under loss."""
    masked = np.array(mask, bool)
    own = np.array([(s["start"], s["end"]) for s in spans if s["loss"]], np.int64).reshape(-1, 2)
    parts = []
    token_starts, token_ends = np.array(starts, np.int64)[masked], np.array(ends, np.int64)[masked]
    for start, end in own.tolist():
        k = slice(np.searchsorted(token_ends, start, "right"), np.searchsorted(token_starts, end, "left"))
        text, at = [], start
        for a, b in zip(token_starts[k].tolist(), token_ends[k].tolist(), strict=True):
            a, b = max(a, at), min(b, end)
            if a < b:
                text.append(formatted[a:b])
                at = b
        parts.append(unescape("".join(text)))
    return "".join(parts)


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id``, the ``turns`` and the ``loss_text`` that the written columns give."""
    kinds = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                piece = batch.slice(at, ROWS_PER_BATCH)
                ids, texts, *rest = piece.columns
                turns = [parse(t) for t in texts.to_pylist()]
                loss = [under_loss(*row) for row in zip(texts.to_pylist(), *[c.to_pylist() for c in rest], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [ids, texts, pa.array(turns, kinds), pa.array(loss, pa.string())],
                    names=["conv_id", "formatted", "turns", "loss_text"],
                )

    id_type = formatted.schema["conv_id"].dataType.simpleString()
    columns = formatted.select("conv_id", "formatted", "turns", "starts", "ends", "loss_mask")
    return columns.mapInArrow(
        run, f"conv_id {id_type}, formatted string, turns array<struct<role:string,text:string>>, loss_text string"
    )

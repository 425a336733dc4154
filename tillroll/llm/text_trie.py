"""A radix trie of whole texts: common beginnings once, the smallest id at each text's end."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

#: Bytes that a text takes beside its own, about: its end, a fork and the row that points at it.
TEXT_OVERHEAD = 500


class Node:
    """``edge`` leads here from the fork above. If a text ends here, ``rows`` are those that
    have it, and ``least`` is their smallest id, if any has one."""

    __slots__ = ("edge", "kids", "least", "rows")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.kids: dict[int, Node] | None = None
        self.least: Any = None
        self.rows: list | None = None


def shared_length(a: bytes, b: bytes, at: int) -> int:
    """How many bytes ``a`` and ``b[at:]`` begin with in common, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class TextTrie:
    """Texts as bytes. ``size`` is about the memory that the trie and its rows take."""

    def __init__(self) -> None:
        self.root = Node(b"")
        self.size = 0

    def insert(self, text: bytes, number: Any, row: Any) -> None:
        """Put ``row`` at the end of ``text``; ``number`` counts for its ``least`` unless None."""
        node, at = self.root, 0
        while at < len(text):
            if node.kids is None:
                node.kids = {}
            kid = node.kids.get(text[at])
            if kid is None:
                kid = node.kids[text[at]] = Node(text[at:])
                self.size += len(text) - at
                node, at = kid, len(text)
            elif text.startswith(kid.edge, at):
                node, at = kid, at + len(kid.edge)
            else:
                k = shared_length(kid.edge, text, at)
                fork = node.kids[text[at]] = Node(kid.edge[:k])
                kid.edge = kid.edge[k:]
                fork.kids = {kid.edge[0]: kid}
                node, at = fork, at + k
        self.size += TEXT_OVERHEAD
        if node.rows is None:
            node.rows = []
        node.rows.append(row)
        if number is not None and (node.least is None or number < node.least):
            node.least = number

    def ends(self) -> Iterator[tuple[Node, bytes, int]]:
        """In order, for each text: its node, itself, and how many bytes the text before it shares."""
        path, open_nodes, shared = bytearray(), [(self.root, 0)], 0
        while open_nodes:
            node, above = open_nodes.pop()
            shared = min(shared, above)
            del path[above:]
            path += node.edge
            if node.rows is not None:
                yield node, bytes(path), shared
                shared = len(path)
            if node.kids:
                open_nodes += [(node.kids[first], len(path)) for first in sorted(node.kids, reverse=True)]
